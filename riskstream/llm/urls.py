"""URLs judged by rules on hosts and paths, and by a weighted vocabulary found in one pass."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from riskstream.llm.common import kept_in_process

ALLOW, BLOCK = "allow", "block"
ASCII_LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
PARTS = re.compile(r"://([^/?#]*)([^?#]*)")
# Letters and digits that stand beside a term make it a part of a longer word.
INSIDE = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")

# One strict term is enough to reject a url; of soft terms it takes several different ones.
STRICT_TERMS = (
    "adult", "bitcoin-doubler", "blowjob", "camgirl", "camgirls", "casino", "casinos", "escort", "escorts", "fuck", "gangbang",
    "hardcore-sex", "hentai", "keygen", "livesex", "milf", "onlyfans", "payday-loan", "payday-loans", "porn", "porno", "pornos",
    "pornhub", "redtube", "sexcam", "sexcams", "viagra", "warez", "xhamster", "xnxx", "xvideos", "xxx", "youporn",
)
SOFT_TERMS = (
    "ads", "adserver", "affiliate", "amateur", "babes", "banner", "bet", "bets", "betting", "bingo", "bonus", "buy", "cam",
    "cams", "cash", "cheap", "cialis", "click", "clickbait", "crack", "cracked", "dating", "deal", "deals", "discount", "drugs",
    "erotic", "farm", "free", "gambling", "girls", "hot", "jackpot", "lottery", "naked", "nude", "odds", "online-pharmacy",
    "pharmacy", "pills", "poker", "popup", "prize", "promo", "replica", "roulette", "serial", "sex", "sexy", "slot", "slots",
    "spam", "teen", "teens", "torrent", "torrents", "track", "tracker", "win", "winner",
)


@dataclass(frozen=True)
class Vocabulary:
    """A strict term weighs as much as `soft_limit` soft ones; a url of that weight is rejected."""
    strict: tuple[str, ...] = STRICT_TERMS
    soft: tuple[str, ...] = SOFT_TERMS
    soft_limit: int = 2

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for terms, strict in ((self.soft, False), (self.strict, True)):     # a term in both lists is strict
            for term in terms:
                found.add_word(term.translate(ASCII_LOWER), (len(term), term, strict))
        found.make_automaton()
        return found


@dataclass(frozen=True)
class Rule:
    """Fits a host and its subdomains where the path starts with `path`."""
    verdict: str
    host: str
    path: str = "/"

    def __str__(self) -> str:
        return self.host + self.path


def parts(url: str | None) -> tuple[str, str]:
    """(host, path). The host lies after the first `://`, with A-Z lower-cased; both are empty without one."""
    found = PARTS.search(url or "")
    return (found[1].translate(ASCII_LOWER), found[2]) if found else ("", "")


def by_host(rules: Sequence[Rule]) -> dict[str, list[Rule]]:
    hosts: dict[str, list[Rule]] = {}
    for rule in sorted(rules, key=lambda r: (-len(r.path), r.verdict)):
        hosts.setdefault(rule.host, []).append(rule)
    return hosts


def longest_rule(hosts: dict[str, list[Rule]], host: str, path: str) -> Rule | None:
    """The longest of the rules that fit; of equally long ones that with the longer host, then the allowing one. Looks up
    the host and each of its parents, so its time does not depend on the number of rules for other hosts."""
    best = None
    while host:
        for rule in hosts.get(host, ()):
            if path.startswith(rule.path):
                if best is None or len(str(rule)) > len(str(best)):
                    best = rule
                break
        host = host.partition(".")[2]
    return best


def term_hits(automaton: ahocorasick.Automaton, url: str | None) -> tuple[int, int, set[str]]:
    """(strict hits, soft hits, different soft terms). A hit has no letter or digit (a-z, 0-9) on either side."""
    strict = soft = 0
    kinds: set[str] = set()
    if url and len(automaton):
        text = url.translate(ASCII_LOWER)
        for last, (length, term, is_strict) in automaton.iter(text):
            first = last - length
            if (first < 0 or text[first] not in INSIDE) and (last + 1 == len(text) or text[last + 1] not in INSIDE):
                if is_strict:
                    strict += 1
                else:
                    soft += 1
                    kinds.add(term)
    return strict, soft, kinds


class Judge:
    """Judges one url at a time. Rules win over the vocabulary."""

    def __init__(self, rules: Sequence[Rule], vocabulary: Vocabulary):
        self.hosts, self.automaton, self.limit = by_host(rules), vocabulary.automaton(), vocabulary.soft_limit

    def __call__(self, url: str | None) -> tuple[str, str, str | None, int, int, int, str]:
        host, path = parts(url)
        rule = longest_rule(self.hosts, host, path)
        strict, soft, kinds = term_hits(self.automaton, url)
        weight = self.limit * strict + len(kinds)
        own = BLOCK if weight >= self.limit else ALLOW
        return host, path, rule and str(rule), strict, soft, len(kinds), rule.verdict if rule else own


def _judge(rules: tuple[Rule, ...], vocabulary: Vocabulary) -> Judge:
    # Plain values as key: classes that travel with a task are new ones in each.
    key = ("urls", tuple((r.verdict, r.host, r.path) for r in rules), vocabulary.strict, vocabulary.soft, vocabulary.soft_limit)
    return kept_in_process(key, lambda: Judge(rules, vocabulary))


def judged(pages: DataFrame, rules: Sequence[Rule] = (), vocabulary: Vocabulary = Vocabulary()) -> DataFrame:
    """(page_id, host, path, rule, strict_hits, soft_hits, soft_terms, verdict): one row per page.

    `rule` is the rule that decided, or null. A null url, or one without `://`, has an empty host and path, so no rule fits; the
    vocabulary still sees what text there is, and a null url is allowed. Rows that repeat are judged each for itself; other columns
    are not read. `rules` and the vocabulary are lists of settings, which every task has whole.
    """
    rules = tuple(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _judge(rules, vocabulary)
        for batch in batches:
            found = [judge(url) for url in batch.column("url").to_pylist()]
            if found:
                texts = [pa.array(values, kind) for values, kind in zip(zip(*found), KINDS)]
                yield pa.RecordBatch.from_arrays([batch.column("page_id"), *texts], ["page_id", *NAMES])

    ids = pages.schema["page_id"].dataType.simpleString()
    columns = ", ".join(f"{name} {'string' if kind == pa.string() else 'long'}" for name, kind in zip(NAMES, KINDS))
    return pages.select("page_id", "url").mapInArrow(run, f"page_id {ids}, {columns}")


NAMES = ("host", "path", "rule", "strict_hits", "soft_hits", "soft_terms", "verdict")
KINDS = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())


def allowed(pages: DataFrame, rules: Sequence[Rule] = (), vocabulary: Vocabulary = Vocabulary()) -> DataFrame:
    """The pages whose url is allowed, with all their columns, whatever these are called besides `url`."""
    rules = tuple(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _judge(rules, vocabulary)
        for batch in batches:
            yield batch.filter(pa.array([judge(url)[-1] == ALLOW for url in batch.column("url").to_pylist()], pa.bool_()))

    return pages.mapInArrow(run, pages.schema)


def oracle(rules: Sequence[Rule], vocabulary: Vocabulary = Vocabulary()) -> str:
    """The same in DuckDB's SQL, one pattern per term."""
    strict = set(vocabulary.strict)
    kinds = [(term, term in strict) for term in dict.fromkeys((*vocabulary.strict, *vocabulary.soft))]
    terms = ", ".join(f"('{term}', {weight})" for term, weight in kinds)
    listed = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in rules) or "(NULL, NULL, NULL)"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH terms(term, strict) AS (VALUES {terms}), rules(r_host, r_path, r_verdict) AS (VALUES {listed}),
parted AS (
  SELECT page_id, row_number() OVER () AS row_no, translate(coalesce(url, ''), '{upper}', '{lower}') AS folded,
         translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{upper}', '{lower}') AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
fitting AS (
  SELECT row_no, r_host || r_path AS rule, r_verdict, row_number() OVER (PARTITION BY row_no
         ORDER BY length(r_host || r_path) DESC, length(r_host) DESC, r_verdict) AS place
  FROM parted JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)),
found AS (
  SELECT row_no, strict, term,
         len(regexp_extract_all(regexp_replace(folded, '[^a-z0-9]', '\\0\\0', 'g'), '(?:^|[^a-z0-9])'
             || regexp_replace(regexp_escape(term), '-', '--', 'g') || '(?:$|[^a-z0-9])')) AS hits
  FROM parted JOIN terms ON contains(folded, term)),
weighed AS (
  SELECT row_no, coalesce(sum(hits) FILTER (strict), 0) AS strict_hits, coalesce(sum(hits) FILTER (NOT strict), 0) AS soft_hits,
         count(*) FILTER (NOT strict AND hits > 0) AS soft_terms FROM found GROUP BY row_no)
SELECT page_id, host, path, rule, CAST(coalesce(strict_hits, 0) AS BIGINT) AS strict_hits,
       CAST(coalesce(soft_hits, 0) AS BIGINT) AS soft_hits, CAST(coalesce(soft_terms, 0) AS BIGINT) AS soft_terms,
       coalesce(r_verdict, CASE WHEN {vocabulary.soft_limit} * coalesce(strict_hits, 0) + coalesce(soft_terms, 0)
                >= {vocabulary.soft_limit} THEN '{BLOCK}' ELSE '{ALLOW}' END) AS verdict
FROM parted LEFT JOIN (SELECT * FROM fitting WHERE place = 1) USING (row_no) LEFT JOIN weighed USING (row_no)"""
