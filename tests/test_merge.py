import pytest
from pyspark.sql import functions as F

from quotelake.operators.history import (
    after_ticker_watermarks,
    after_watermark,
    in_batch,
    lookback,
    next_ticker_watermarks,
    next_watermark,
    tail_rows,
    years_for_lookback,
)
from quotelake.operators.keys import assign_keys
from quotelake.operators.merge import (
    insert_counts,
    key_violations,
    merge_dimension,
    replace_slices,
    split_valid,
    upsert,
)
from tests.conftest import plan

DDL = "ticker string, date int, v double"


@pytest.fixture
def table(spark):
    return spark.createDataFrame([("A", 1, 1.0), ("A", 2, 2.0), ("B", 1, 3.0)], DDL)


def test_upsert(spark, rows, table):
    batch = spark.createDataFrame([("A", 2, 9.0), ("A", 2, 8.0), ("C", 1, 7.0)], DDL)
    once = upsert(table, batch, ["ticker", "date"], ["v"])
    assert rows(once) == [("A", 1, 1.0), ("A", 2, 9.0), ("B", 1, 3.0), ("C", 1, 7.0)]
    assert rows(upsert(once, batch, ["ticker", "date"], ["v"])) == rows(once)
    empty = table.limit(0)
    assert rows(upsert(empty, batch, ["ticker", "date"], ["v"])) == [("A", 2, 9.0), ("C", 1, 7.0)]
    assert rows(upsert(table, empty, ["ticker", "date"], ["v"])) == rows(table)


def test_upsert_null_key_and_new_column(spark, rows, table):
    table = table.unionAll(spark.createDataFrame([(None, 1, 0.0)], DDL))
    batch = spark.createDataFrame([(None, 1, 5.0, "x")], DDL + ", note string")
    got = upsert(table.withColumn("note", F.lit(None).cast("string")), batch, ["ticker", "date"], ["v"])
    assert rows(got.where("ticker is null")) == [(None, 1, 5.0, "x")]


def test_replace_slices(spark, rows, table):
    batch = spark.createDataFrame([("A", 1, 9.0)], DDL)
    whole = replace_slices(table, batch, ["date"])
    assert rows(whole) == [("A", 1, 9.0), ("A", 2, 2.0)]
    narrow = replace_slices(table, batch, ["date", "ticker"])
    assert rows(narrow) == [("A", 1, 9.0), ("A", 2, 2.0), ("B", 1, 3.0)]
    assert rows(replace_slices(narrow, batch, ["date", "ticker"])) == rows(narrow)


def test_merge_dimension(spark, rows):
    ddl = "id int, name string, city string"
    table = spark.createDataFrame([(1, "a", "x"), (2, "b", None)], ddl)
    batch = spark.createDataFrame([(2, "B", "y"), (2, "C", None), (3, "c", "z")], ddl)
    assert rows(merge_dimension(table, batch, ["id"], ["name"])) == [(1, "a", "x"), (2, "C", None), (3, "c", "z")]
    assert rows(merge_dimension(table, batch, ["id"], ["name"], update=["name"])) == [
        (1, "a", "x"),
        (2, "C", None),
        (3, "c", "z"),
    ]
    kept = merge_dimension(table, batch, ["id"], ["name"], update=[])
    assert rows(kept) == [(1, "a", "x"), (2, "b", None), (3, "c", "z")]
    partial = merge_dimension(table, batch.select("id", "name"), ["id"], ["name"])
    assert rows(partial) == [(1, "a", "x"), (2, "C", None), (3, "c", None)]


def test_split_valid(spark, rows):
    ddl = "k int, name string, v double"
    batch = spark.createDataFrame(
        [(1, "a", 2.0), (1, "b", 1.0), (1, "b", 1.0), (None, "c", 1.0), (2, "toolong", 1.0), (3, None, 1.0), (4, "d", 1.0)],
        ddl,
    )
    held = spark.createDataFrame([(4, "old", 0.0)], ddl)
    accepted, rejected = split_valid(batch, ["k"], ["v"], ["name"], {"name": 5}, held)
    assert rows(accepted) == [(1, "b", 1.0)]
    assert rows(rejected, "k", "reason", "copies") == [
        (None, "missing: k", 1),
        (1, "duplicate key", 1),
        (1, "duplicate key", 1),
        (2, "too long: name", 1),
        (3, "missing: name", 1),
        (4, "key exists", 1),
    ]
    assert tuple(insert_counts(accepted, rejected).head()) == (1, 6, 7)


def test_counts_of_an_empty_batch(spark):
    batch = spark.createDataFrame([], "k int, v double")
    assert tuple(insert_counts(*split_valid(batch, ["k"], ["v"])).head()) == (0, 0, 0)


def test_key_violations(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert rows(key_violations(df, ["k"])) == [(None, 1), (1, 2)]


def test_keys_are_stable_and_dense(spark):
    names = spark.createDataFrame([(f"n{i}",) for i in range(200)] + [(None,), ("n3",)], "name string")
    first = {r["name"]: r["id"] for r in assign_keys(None, names.repartition(5), "id", "name").collect()}
    again = {r["name"]: r["id"] for r in assign_keys(None, names.repartition(2).orderBy("name"), "id", "name").collect()}
    assert first == again and sorted(first.values()) == list(range(1, 201))
    known = spark.createDataFrame([(7, "n3"), (900, "gone")], "id int, name string")
    grown = {r["name"]: r["id"] for r in assign_keys(known, names, "id", "name").collect()}
    assert grown["n3"] == 7 and grown["gone"] == 900
    assert sorted(set(grown.values()) - {7, 900}) == list(range(901, 901 + 199))


def test_watermarks(spark, rows):
    import datetime as dt

    d = dt.date
    df = spark.createDataFrame([("A", d(2024, 1, 1)), ("A", d(2024, 1, 3)), ("B", d(2024, 1, 2))], "ticker string, date date")
    mark = F.lit("2024-01-02").cast("date")
    assert rows(after_watermark(df, mark)) == [("A", d(2024, 1, 3))]
    assert next_watermark(df, mark).head()[0] == d(2024, 1, 3)
    assert next_watermark(df.limit(0), mark).head()[0] == d(2024, 1, 2)
    marks = spark.createDataFrame([("A", d(2024, 1, 1)), ("C", d(2023, 1, 1))], "ticker string, last_date date")
    assert rows(after_ticker_watermarks(df, marks)) == [("A", d(2024, 1, 3)), ("B", d(2024, 1, 2))]
    assert rows(next_ticker_watermarks(df, marks)) == [
        ("A", d(2024, 1, 3)),
        ("B", d(2024, 1, 2)),
        ("C", d(2023, 1, 1)),
    ]


def test_lookback_excludes_batch_dates_and_later(spark, rows):
    history = spark.createDataFrame([("A", i) for i in range(10)] + [("B", 1)], "ticker string, date int")
    batch = spark.createDataFrame([("A", 7), ("A", 12)], "ticker string, date int")
    assert rows(lookback(history, batch, 3)) == [("A", 4), ("A", 5), ("A", 6)]
    assert rows(in_batch(history, batch)) == [("A", 7)]


def test_tail_cuts_before_the_shuffle(spark):
    df = spark.createDataFrame([("A", i) for i in range(10)], "ticker string, date int")
    text = plan(tail_rows(df, 2))
    assert text.count("WindowGroupLimit") == 2
    assert sorted(r["date"] for r in tail_rows(df, 2).collect()) == [8, 9]


def test_years_for_lookback(spark, rows):
    import datetime as dt

    data = [("A", dt.date(y, 6, d), y) for y in (2019, 2020, 2021, 2022) for d in (1, 2, 3)]
    data += [("B", dt.date(2018, 1, 1), 2018), ("B", dt.date(2022, 1, 1), 2022), ("C", dt.date(2022, 1, 1), 2022)]
    history = spark.createDataFrame(data, "ticker string, date date, year int")
    batch = spark.createDataFrame([("A", dt.date(2022, 6, 2)), ("B", dt.date(2023, 1, 1))], "ticker string, date date")
    got = years_for_lookback(history, batch, 4)
    assert {(r["ticker"], r["year"]) for r in got.collect()} == {("A", 2022), ("A", 2021), ("A", 2020), ("B", 2022), ("B", 2018)}
    assert rows(lookback(got, batch, 4)) == rows(lookback(history, batch, 4))
    assert years_for_lookback(history, batch.limit(0), 4).isEmpty()


def test_stored_rows_are_judged_once(spark, rows):
    data = [(k % 40, k % 3 and k % 7, k % 2) for k in range(90)] + [(5, 1, 1)] * 3 + [(None, 1, 1), (6, None, 0)]
    batch = spark.createDataFrame(data, "a int, b int, c int")
    held = spark.createDataFrame([(3,), (None,)], "a int")
    stored = []

    def store(df, purpose):
        stored.append(purpose)
        return df

    plain = split_valid(batch, ["a"], ["b"], ["b"], table=held)
    checked = split_valid(batch, ["a"], ["b"], ["b"], table=held, store=store)
    assert [rows(df) for df in checked] == [rows(df) for df in plain]
    assert stored == ["judged", "repeated"]
