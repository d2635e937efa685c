import pytest

from ledgerloom.operators import tables as T
from ledgerloom.plans import views as V
from ledgerloom.sources import bulk, rest, state_csv
from ledgerloom.streaming import incremental as I


def test_upsert_is_idempotent_and_keeps_old_values(spark):
    t = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, v string, w string")
    s = spark.createDataFrame([(2, None, "z"), (3, "c", "q")], "id int, v string, w string")
    once = T.upsert(t, s, ["id"], ["v", "w"])
    rows = sorted(map(tuple, once.collect()))
    assert rows == [(1, "a", "x"), (2, "b", "z"), (3, "c", "q")]
    assert sorted(map(tuple, T.upsert(once, s, ["id"], ["v", "w"]).collect())) == rows


def test_repeated_source_keys_count_once(spark):
    t = spark.createDataFrame([(1, "a")], "id int, v string")
    s = spark.createDataFrame([(1, "c"), (1, "b"), (2, "e"), (2, "d")], "id int, v string")
    assert sorted(map(tuple, T.upsert(t, s, ["id"], ["v"]).collect())) == [(1, "b"), (2, "d")]
    assert sorted(map(tuple, T.insert_if_absent(t, s, ["id"]).collect())) == [(1, "a"), (2, "d")]
    assert sorted(map(tuple, T.insert_if_absent(t.select("id"), s.select("id"), ["id"]).collect())) == [(1,), (2,)]


def test_cut_refuses_a_local_folder_off_a_local_master():
    from ledgerloom import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Far:
        conf = Conf()

    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        session.shared_folder(Far())


def test_cut_tables_are_deleted(spark):
    from ledgerloom import session

    a = session.cut(spark.range(3))
    b = session.cut(a.where("id > 0"))
    session.discard(a, spark.range(1))
    assert b.count() == 2 and a._cut_path not in session._tables
    session.release(spark)
    assert not session._tables


def test_state_counts_rows_read_again_once(spark):
    cols = "recipient_committee_id long, election_cycle int, contribution_date date, source_sub_id string"
    rows = spark.sql("select 1L recipient_committee_id, 2024 election_cycle, date_add(date'2024-01-01', cast(id as int)) contribution_date, cast(id as string) source_sub_id from range(5) t(id)")
    state = I.extraction_state(rows.where("contribution_date < '2024-01-04'"))
    read = I.window_rows(rows, state, 2)
    merged = I.merge_state(state, read)
    assert [(r.n, str(r.last_date)) for r in merged.collect()] == [(5, "2024-01-05")]
    assert [r.n for r in I.merge_state(merged, read).collect()] == [5]
    assert I.merge_state(merged, spark.createDataFrame([], cols)).first().n == 5


def test_reconciliation(spark):
    t = spark.createDataFrame([(1, "a"), (9, "z")], "id int, v string")
    s = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "id int, v string")
    missing, counts = I.reconcile(t, s, ["id"])
    assert [tuple(r) for r in missing.collect()] == [(2, "b")] and tuple(counts.first()) == (3, 2, 1, 1)


def test_new_ids_are_dense_and_ordered(spark):
    new = spark.createDataFrame([(f"k{i:03d}",) for i in range(50)], "k string")
    taken = spark.createDataFrame([(7,)], "id long")
    got = sorted((r.k, r.id) for r in T.with_new_ids(new, taken, ["k"]).collect())
    assert [i for _, i in got] == list(range(8, 58))


def test_versioned_table(spark, tmp_path):
    t = T.VersionedTable(spark, f"file://{tmp_path}/v")
    t.write(spark.range(3))
    t.write(t.read().where("id > 0"))
    assert t.read().count() == 2
    t.rollback()
    assert t.read().count() == 3


def test_refresh_isolates_failures(spark, tmp_path):
    def broken():
        raise ValueError

    status = V.refresh({"good": lambda: spark.range(2), "bad": broken}, f"file://{tmp_path}/views")
    assert status == {"good": "refreshed", "bad": "failed: ValueError"}


def test_earmark_mini_fact(spark):
    data = [
        (1, "FEC", "T1", 10, None, False), (2, "FEC", "T1E", 20, None, False), (3, "FEC", "T2", 30, None, False),
        (4, "FEC", "T3", 20, "Earmarked via X", False), (5, "FEC", None, 20, None, False), (6, "MARYLAND", None, 40, "conduit", False),
    ]
    f = spark.createDataFrame(data, "id int, source_system string, source_transaction_id string, recipient_committee_id long, memo_text string, is_earmark_receipt boolean")
    f = f.selectExpr("*", "cast(null as bigint) as conduit_committee_id")
    marked = V.mark_receipts(f)
    assert [r.id for r in marked.where("is_earmark_receipt").collect()] == [1]
    assert {r.id: r.conduit_committee_id for r in V.assign_conduits(f).collect()}[2] == 10
    assert sorted(r.id for r in V.counted(marked).collect()) == [3, 5, 6]


def test_bulk_scan_keeps_zeros_and_quotes(spark, tmp_path):
    (tmp_path / "h.csv").write_text("CMTE_ID,NAME,ZIP_CODE,TRANSACTION_DT,TRANSACTION_AMT,ENTITY_TP,STATE,SUB_ID\n")
    (tmp_path / "f.txt").write_text('C1|"DOE, ""JAY"""|021391234|1052024|12.5|IND|md|9\nC2|NULL|123|02302024|x|ORG|VA|10\n')
    rows = {r.sub_id: r for r in bulk.contributions(spark, [(f"{tmp_path}/f.txt", f"{tmp_path}/h.csv")], 2024).collect()}
    assert (rows["9"].contributor_name, rows["9"].contributor_zip, rows["9"].contributor_state, str(rows["9"].contribution_receipt_date)) == ('DOE, "JAY"', "02139", "MD", "2024-01-05")
    assert (rows["10"].contributor_name, rows["10"].contributor_zip, rows["10"].contribution_receipt_date, rows["10"].contribution_receipt_amount) == (None, None, None, None)


def test_state_candidate_layouts(spark, tmp_path):
    (tmp_path / "c2020.csv").write_text("Mayor,D1,Ann B Lee,DEM,X County,Active,Regular,a@b,,,,\n")
    (tmp_path / "c2022_special.csv").write_text("Office Name,Candidate Ballot Last Name and Suffix,Candidate First Name and Middle Name\nSheriff,Roe,Kim\n")
    df = state_csv.candidate_years(spark, {2020: f"{tmp_path}/c2020.csv", 2022: f"{tmp_path}/c2022_special.csv", 2016: f"{tmp_path}/c2020.csv"})
    got = {(r.candidate_first_name, r.candidate_last_name, r.election_year, r.election_type) for r in df.collect()}
    assert got == {("Ann B", "Lee", 2020, "Primary"), ("Kim", "Roe", 2022, "Special")}


def pages(params):
    start = params.get("last", 0)
    rows = [{"sub_id": f"{params['key']}-{i}", "amount": i} for i in range(start, min(start + 2, 5))]
    return {"results": rows, "next": {"last": start + 2} if start + 2 < 5 else None}


def test_paged_reader_and_limits():
    from pyspark.sql.types import StructType

    schema = StructType().add("sub_id", "string").add("raw_json", "string")
    reader = rest.PagedReader(schema, {"keys": "a,b", "transport": f"{__name__}:pages", "gap": "0"})
    rows = [row for p in reader.partitions() for row in reader.read(p)]
    assert [r[0] for r in rows] == [f"{k}-{i}" for k in "ab" for i in range(5)]
    now = [0.0]
    limit = rest.RateLimit({10.0: 2}, 1.0, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    times = []
    for _ in range(4):
        limit.wait()
        times.append(now[0])
    assert times == [0.0, 1.0, 10.0, 11.0]


def test_paged_reader_shares_the_quota_and_resumes():
    from pyspark.sql.types import StructType

    schema = StructType().add("sub_id", "string").add("next_cursor", "string")
    options = {"keys": ",".join("abcdefgh"), "transport": f"{__name__}:pages", "gap": "0", "perminute": "40", "parallel": "4"}
    parts = rest.PagedReader(schema, options).partitions()
    assert len(parts) == 4 and sorted(k for p in parts for k in p.keys) == list("abcdefgh") and all(40 // p.share == 10 for p in parts)
    reader = rest.PagedReader(schema, options | {"keys": "a,b", "cursors": '{"a": {"last": 2}, "b": null}'})
    rows = [row for p in reader.partitions() for row in reader.read(p)]
    assert rows == [("a-2", '{"last": 4}'), ("a-3", '{"last": 4}'), ("a-4", "null")]


def test_missing_bulk_files_are_passed_over(spark, tmp_path):
    (tmp_path / "h.csv").write_text("CMTE_ID,NAME,ZIP_CODE,TRANSACTION_DT,TRANSACTION_AMT,ENTITY_TP,STATE,SUB_ID\n")
    (tmp_path / "f.txt").write_text("C1|DOE|02139|1052024|12.5|IND|md|9\n")
    files = [(f"{tmp_path}/f.txt", f"{tmp_path}/h.csv"), (f"{tmp_path}/none.txt", f"{tmp_path}/h.csv")]
    assert bulk.contributions(spark, files, 2024).count() == 1


def test_state_filters_and_file_names(spark, tmp_path):
    head = "Receiving Committee,Filing Period,Contribution Date,Contributor Name,Contributor Address,Contributor Type,Contribution Type,Contribution Amount,Employer Name,Employer Occupation,Office,Fundtype"
    lines = ["A,2024 Annual,01/05/2024,X,,,,1,,,,", "A,2025 Annual,02/05/2025,Y,,,,2,,,,", '"A, ""B""",2025 Annual,03/05/2025,Z,,,,3,,,,']
    (tmp_path / "c.csv").write_text("\n".join([head, *lines]) + "\n")
    names = lambda df: sorted(r.contributor_name for r in df.collect())
    assert names(state_csv.contributions(spark, f"{tmp_path}/c.csv")) == ["X", "Y", "Z"]
    assert names(state_csv.contributions(spark, f"{tmp_path}/c.csv", years=[2025], last="2025-02-28")) == ["Y"]
    from pyspark.sql import functions as F

    assert spark.range(1).select(state_csv.election_type(F.lit("/special/2022/general.csv")).alias("t")).first().t == "General"


def test_new_files_are_seen_once(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/in/a")
    seen = []
    run = lambda: I.run_new_files(spark, "id long", f"{tmp_path}/in/*", f"{tmp_path}/ckpt", lambda b, _: seen.append(b.count()))
    run()
    run()
    spark.range(2).write.parquet(f"{tmp_path}/in/b")
    run()
    assert seen == [3, 2]


def test_lookback_zero_is_not_the_default(spark):
    s = spark.sql("select 1L recipient_committee_id, 2024 election_cycle, date'2024-01-10' last_date, 'x' last_sub_id, 1L n")
    assert str(I.start_dates(s, 0).first().start_date) == "2024-01-10"
    assert str(I.start_dates(s, None).first().start_date) == "2024-01-09"
