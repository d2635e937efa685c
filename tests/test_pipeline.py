from pyspark.sql import functions as F

from ledgerloom.plans import linkage, pipeline, quality


def _bronze(spark):
    rows = [
        (1, "h1", "Friends of A", "2024 Annual", "01/02/2024", "Doe, Jane", "1 Oak St  Big Town MD 21000", "Individual", "Check", "10.00", "nan", "None", "Mayor", "Electoral"),
        (2, "h1", "Friends of A", "2024 Annual", "01/02/2024", "Doe, Jane", "1 Oak St  Big Town MD 21000", "Individual", "Check", "10.00", "nan", "None", "Mayor", "Electoral"),
        (3, "h2", "Friends of A", "2025 Annual", "1/3/2025", "Acme, Inc.", "2 Elm St  Big Town MD 21000", "Business", None, "20", None, None, None, "Electoral"),
        (4, "h3", "Nobody", "2025 Annual", "02/30/2025", "X", "", "Individual", "Check", "5", None, None, None, None),
        (5, "h4", "Nobody", "2025 Annual", "02/20/2025", "X", "", "Individual", "Check", "1,000", None, None, None, None),
    ]
    names = "receiving_committee filing_period contribution_date contributor_name contributor_address contributor_type contribution_type contribution_amount employer_name employer_occupation office fund_type"
    return spark.createDataFrame(rows, "id long, content_hash string, " + ", ".join(f"{c} string" for c in names.split()))


def test_state_layers(spark):
    committees = spark.createDataFrame([("Friends of A", " 7 ", "Candidate Committee"), ("Friends of A", "8", "Candidate Committee")], "committee_name string, ccf_id string, committee_type string")
    silver = pipeline.silver_state_contributions(_bronze(spark), committees).cache()
    got = {r.source_content_hash: r for r in silver.collect()}
    assert set(got) == {"h1", "h2"}
    assert (got["h1"].employer_name, got["h1"].contributor_state, got["h1"].contributor_zip) == ("NOT PROVIDED", "MD", "21000")
    none = spark.createDataFrame([], "match_key string, id long")
    people = pipeline.gold_contributors(silver, none).cache()
    assert {r.match_key: r.entity_type for r in people.collect()}["ORG|ACME INC"] == "ORG"
    assert sorted(r.id for r in people.collect()) == [1, 2]
    assert pipeline.gold_contributors(silver, people.select("match_key", "id")).count() == 0
    gold_committees = spark.createDataFrame([(70, "7")], "id long, state_committee_id string")
    empty = spark.createDataFrame([], "source_system string, source_sub_id string")
    facts = pipeline.gold_contributions(silver, people, gold_committees, empty).cache()
    assert {(r.source_sub_id, r.recipient_committee_id, r.contribution_type, r.election_cycle) for r in facts.collect()} == {("h1", 70, "Check", 2024), ("h2", 70, "DIRECT", 2026)}
    assert facts.agg(F.sum("amount")).first()[0] == silver.agg(F.sum("contribution_amount")).first()[0]
    assert pipeline.gold_contributions(silver, people, gold_committees, facts.select("source_system", "source_sub_id")).count() == 0


def test_federal_enrichment(spark):
    bronze = spark.sql("""select * from values ('s1', 'C1', date'2024-01-01', 5.0, 'A', null), ('s1', 'C1', date'2024-01-01', 5.0, 'A', null), ('s2', 'C2', date'2024-01-01', 6.0, 'B', 'K9'),
      ('s3', 'C1', null, 7.0, 'C', null) t(sub_id, committee_id, contribution_receipt_date, contribution_receipt_amount, contributor_name, candidate_id)""")
    committees = spark.sql("select * from values ('C1', 'One', 'H', array('K1', 'K2')), ('C2', 'Two', 'S', null) t(committee_id, name, committee_type, candidate_ids)")
    candidates = spark.sql("select * from values ('K1', 'Ann', 'H'), ('K9', 'Bob', 'S') t(candidate_id, name, office)")
    got = {r.sub_id: (r.candidate_id, r.candidate_name, r.committee_name) for r in pipeline.silver_federal_contributions(bronze, committees, candidates).collect()}
    assert got == {"s1": ("K1", "Ann", "One"), "s2": ("K9", "Bob", "Two")}


def test_linkage_passes(spark):
    committees = spark.sql("""select * from values (1L, 'X', 'PAC', 5L, null), (2L, 'X', 'CANDIDATE', null, 'S2'), (3L, 'Ann Roe', 'CANDIDATE', null, null),
      (4L, 'Friends of Bob Lee', 'CANDIDATE', null, null), (5L, 'Friends of Nobody', 'CANDIDATE', null, null) t(id, name, committee_type, candidate_id, state_committee_id)""")
    candidates = spark.sql("select * from values (10L, 'Zed', 'S2'), (11L, 'Ann Roe', null), (12L, 'Bob Lee', null) t(id, name, state_candidate_id)")
    got = {r.id: (r.candidate_id, r.link_method) for r in linkage.link_committees(committees, candidates).collect()}
    assert got == {1: (5, "given"), 2: (10, "state_id"), 3: (11, "name"), 4: (12, "variant"), 5: (None, None)}


def test_quality(spark):
    status = lambda a, b: quality.stage_status("s", spark.range(a), spark.range(b)).first().status
    assert [status(10, 9), status(10, 3), status(10, 0), status(0, 0)] == ["success", "warning", "error", "success"]
    rates = spark.createDataFrame([(100, 0, 0), (100, 5, 0), (100, 5, 20)], "n long, no_contributor long, no_committee long")
    assert [r.status for r in quality.link_status(rates).collect()] == ["success", "warning", "error"]
