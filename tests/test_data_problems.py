import csv
import datetime as dt
import decimal
import io
import random
from collections import Counter, defaultdict

from ledgerloom.operators import quarantine as Q
from ledgerloom.operators import references as R
from ledgerloom.operators import skew as S
from ledgerloom.plans import data_queries
from ledgerloom.sources.state_csv import CONTRIBUTION
from pyspark.sql import functions as F

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
REF = R.Reference("t", "k", "u", "id")


def _rows(spark, data):
    df = spark.createDataFrame(data, "id long, k string, created_at timestamp_ntz, refs int")  # refs: a clashing name
    return R.reference_rows(df, [REF], "id", "created_at", F.lit("2024-01"))


def test_orphans_missing_late_blank_null_and_repeated(spark):
    rows = _rows(spark, [(1, " 7 ", T1, 0), (2, "7", T0, 0), (3, "8", T1, 0), (3, "8", T1, 0), (4, None, T1, 0), (5, "  ", T1, 0)])
    target = spark.createDataFrame([("7", dt.datetime(2024, 1, 15))], "id string, created_at timestamp_ntz")
    state = R.apply_deltas(None, R.reference_deltas(rows), R.existence_deltas(target, REF, "created_at"))
    got = sorted((r.row_id, r.kind) for r in R.orphan_rows(rows, state).collect())
    assert got == [(2, "late"), (3, "missing"), (3, "missing"), (5, "missing")]
    report = R.orphan_report(R.orphan_rows(rows, state)).collect()
    assert {(r.kind, r.n_rows, r.n_keys) for r in report} == {("late", 1, 1), ("missing", 3, 2)}


def test_deltas_follow_arrivals_and_departures(spark):
    rows = _rows(spark, [(1, "a", T0, 0), (2, "b", T0, 0)])
    target = spark.createDataFrame([("a", T0)], "id string, created_at timestamp_ntz")
    state = R.apply_deltas(None, R.reference_deltas(rows), R.existence_deltas(target, REF, "created_at"))
    assert [r.ref_key for r in R.orphan_keys(state).collect()] == ["b"]
    state = R.apply_deltas(state, R.reference_deltas(rows.where("ref_key = 'b'"), -1), R.existence_deltas(target, REF, "created_at", -1))
    assert [(r.ref_key, r.refs) for r in R.orphan_keys(state).collect()] == [("a", 1)]


def test_empty_tables(spark):
    rows = _rows(spark, [])
    state = R.apply_deltas(None, R.reference_deltas(rows))
    assert R.orphan_rows(rows, state).count() == 0
    empty = spark.createDataFrame([], "k long, amount decimal(12,2), m long")
    assert S.key_profile(empty, "k", "amount", "m").count() == 0


def test_profile_against_brute_force(spark):
    rng = random.Random(3)
    data = []
    for i in range(3000):
        key = rng.choice([1, 1, 1, 2, 3, None])
        value = rng.choice([None, rng.randint(-500, 200000) / 100, 25, 0])
        data.append((key, None if value is None else f"{value:.2f}", rng.choice([None, *range(40)])))
    df = spark.createDataFrame(data, "k long, a string, m long").withColumn("amount", F.col("a").cast("decimal(12,2)"))
    got = {r.k: r for r in S.key_profile(df, "k", "amount", "m").collect()}
    by, members, rows = defaultdict(list), defaultdict(list), Counter()
    for k, v, m in data:
        rows[k] += 1
        if v is not None:
            by[k].append(round(float(v) * 100))
        if m is not None:
            members[k].append(m)
    for k in rows:
        values = sorted(by[k])
        mode = min(Counter(values).items(), key=lambda x: (-x[1], x[0]))[0]
        assert got[k].n_rows == rows[k]
        assert round(got[k].total_amount * 100) == sum(values)
        assert round(got[k].mode_amount * 100) == mode
        for p, c in ((0.5, "p50_amount"), (0.9, "p90_amount")):
            rank = max(1, -(-len(values) * round(p * 10) // 10))
            assert round(got[k][c] * 100) == values[rank - 1]
        assert got[k].distinct_members == len(set(members[k]))


def test_key_with_only_nulls(spark):
    df = spark.createDataFrame([(1, None, 5)], "k long, amount decimal(12,2), m long")
    r = S.key_profile(df, "k", "amount", "m").first()
    assert (r.n_rows, r.mode_amount, r.p50_amount, r.distinct_members) == (1, None, None, 1)


def _lines(spark, lines):
    return Q.parse_lines(spark.createDataFrame(list(enumerate(lines)), "raw_id long, line string"), "raw_id", "line")


def test_lines_with_reasons(spark):
    good = "a,b,01/02/2024,d,e,f,g,5.00,i,j,k,l"
    cases = {
        good: None,
        good + ",": None,
        good + ',""': None,
        good + ",x": "columns",
        "a,b": "columns",
        "": "columns",
        good.replace("a,", '"a ""x"", y",', 1): None,
        good.replace("a,", '"a"x,', 1): "quoting",
        good.replace("a,", '"a" ,', 1): "quoting",
        good.replace("a,", '"a,', 1): "quoting",
        good.replace("a,", 'a "x",', 1): None,
        good.replace("a,", '"",', 1): None,
        '"' + "x" * 100_000 + '",' + good[2:]: None,
        '"' + '""' * 20_000 + '",' + good[2:]: None,
    }
    got = {r.row_id: r.structure for r in _lines(spark, list(cases)).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())


def test_quoted_fields_read_like_the_csv_module(spark):
    rng = random.Random(1)
    rows = [[rng.choice(["", "x", 'q"u', "a,b", '"', ' "', "é"]) for _ in range(12)] for _ in range(200)]
    lines = []
    for r in rows:
        buffer = io.StringIO()
        csv.writer(buffer, quoting=csv.QUOTE_ALL, lineterminator="").writerow(r)
        lines.append(buffer.getvalue())
    got = {r.row_id: r for r in _lines(spark, lines).collect()}
    assert all(got[i].structure is None and got[i].date_text == r[2] and got[i].amount_text == r[7] for i, r in enumerate(rows))


def test_valid_rows_are_loaded_whole_from_both_tables(spark, tmp_path):
    names = list(CONTRIBUTION.values())
    good = ["Roe, Ann", 'q"u', " 2/29/2024 ", "", "e", "f", "g", "-5.25", "i", "j", "k", "l"]
    rows = [good, [*good[:7], "$5", *good[8:]], [*good[:2], "TBD", *good[3:]], good[:11], [*good[:2], "", *good[3:7], "", *good[8:]]]
    lines = []
    for r in [names, *rows]:
        buffer = io.StringIO()
        csv.writer(buffer, lineterminator="").writerow(r)
        lines.append(buffer.getvalue())
    lines[-1] += ","
    schema = "raw_id long, file_name string, line_no long, line string"
    spark.createDataFrame([(i, "f", i + 1, x) for i, x in enumerate([*lines, '"broken', None])], schema).write.parquet(f"{tmp_path}/md_contribution_raw.parquet")
    bronze = [[None if x == "" else x for x in r] for r in rows if len(r) == 12]
    spark.createDataFrame([(100 + i, *r) for i, r in enumerate(bronze)], "id long, " + ", ".join(f"{c} string" for c in names)).write.parquet(f"{tmp_path}/bronze_md_contribution.parquet")
    got = {r.row_id: tuple(r) for r in data_queries.p7_loaded_rows(spark, str(tmp_path)).collect()}

    def typed(r):
        full = r[2] not in ("", None)
        return (*r[:2], dt.date(2024, 2, 29) if full else None, *r[3:7], decimal.Decimal("-5.25") if full else None, *r[8:])

    raw = {1: rows[0], 5: rows[4]}
    assert got == {i: ("md_contribution_raw", i, *typed(r)) for i, r in raw.items()} | {i: ("bronze_md_contribution", i, *typed(bronze[i - 100])) for i in (100, 103)}


def test_amounts_and_dates(spark):
    amounts = {"5": True, "-5.25": True, "1234567890.12": True, "12345678901": False, "5.": False, ".5": False, "5.123": False, "$5": False, "1e3": False, "٥": False}
    dates = {"2/29/2024": True, "02/29/2023": False, "13/01/2024": False, "1/1/24": False, "00/10/2024": False, "12/31/2024": True, "4/31/2024": False, "TBD": False}
    df = spark.createDataFrame([("amount", v) for v in amounts] + [("date", v) for v in dates] + [("amount", "  "), ("date", ""), ("amount", " 7 ")], "kind string, value string")
    bad = {(r.kind, r.value) for r in Q.bad_values(df).collect()}
    assert bad == {("amount", v) for v, ok in amounts.items() if not ok} | {("date", v) for v, ok in dates.items() if not ok}
