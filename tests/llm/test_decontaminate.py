import duckdb

from riskstream.llm.decontaminate import benchmark_hits, decontaminated
from riskstream.llm.queries import ORACLES, op10_decontamination

SF = "/root/testdata/sf0.001"
ITEM = "Anna buys 3 kg of apples for 7 euros and Anna then sells 3 of them to her good friend Bob in the park"
FILL = "these words come before the question and are of no use at all, "


def test_query_equals_sql(spark):
    duck = duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    found = op10_decontamination(spark, SF)
    expected = duck.sql(ORACLES["op10_decontamination"])
    assert found.columns == expected.columns
    assert sorted(map(tuple, found.collect())) == sorted(expected.fetchall()) != []


def hits(spark, docs, items):
    return {(r.doc_id, r.item_id): r.same for r in benchmark_hits(
        docs, spark.createDataFrame(items, "item_id long, text string")).collect()}


def test_other_numbers_names_and_units_are_caught_if_consistent(spark, docs_of):
    rows = [(1, FILL + ITEM), (2, FILL + ITEM.replace("Anna", "Eve").replace("3", "8").replace("kg", "lb").replace("7", "12")),
            (3, FILL + ITEM.replace("Anna", "Eve", 1).replace("3", "8", 1)), (4, FILL + "nothing to see here"),
            (5, FILL + ITEM[:40] + " something else altogether that the item does not have")]
    assert hits(spark, docs_of(rows), [(10, ITEM)]) == {(1, 10): True, (2, 10): False}


def test_a_template_without_slots_and_one_changed_word(spark, docs_of):
    item = "a question about the sum of all the things that are in the box on the table of the room with the door to the garden and the lake"
    rows = [(1, item), (2, item.replace("box", "bag")), (3, item.replace("box", "bag").replace("door", "gate").replace("sum", "total"))]
    assert set(hits(spark, docs_of(rows), [(10, item), (11, "four words are few"), (12, None), (None, item)])) == {(1, 10), (2, 10)}


def test_odd_rows(spark, odd_docs, docs_of):
    items = spark.createDataFrame([(1, "one two three four five six", "x"), (1, "one two three four five six", "x")],
                                  "item_id long, text string, window string")
    found = benchmark_hits(odd_docs, items).collect()
    assert [(r.doc_id, r.item_id, r.windows) for r in found] == [(3, 1, 2)]
    left = decontaminated(odd_docs, items)
    assert left.columns == odd_docs.columns and left.count() == odd_docs.count() - 2
    assert decontaminated(docs_of([]), items).count() == 0
    assert decontaminated(odd_docs, items.where("false")).count() == odd_docs.count()


def test_copies_in_other_case_are_dropped(spark, docs_of):
    items = spark.createDataFrame([(10, ITEM)], "item_id long, text string")
    rows = [(1, FILL + ITEM.upper()), (2, FILL + ITEM.lower()), (3, ITEM.title()), (4, FILL.upper()),
            (5, FILL + ITEM.upper().replace("3", "8", 1)), (6, FILL + ITEM.upper().replace("3", "8").replace("KG", "LB"))]
    assert sorted(r.doc_id for r in decontaminated(docs_of(rows), items).collect()) == [4, 5]
