"""Queries of codes, names and layer transforms. Their SQL states every value as a literal, apart from the engine's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import codes, text
from ledgerloom.operators import tables as T
from ledgerloom.plans import linkage, pipeline, quality
from ledgerloom.plans import views as V
from ledgerloom.session import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):  # noqa: ANN201
    def register(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return register


def _values(pairs: list[tuple]) -> str:
    def lit(v: object) -> str:
        return "NULL" if v is None else "'" + v.replace("'", "''") + "'"

    return "(VALUES " + ", ".join("(" + ", ".join(lit(v) for v in p) + ")" for p in pairs) + ")"


def _inputs(s: SparkSession, pairs: list[tuple], n: int = 1) -> DataFrame:
    rows = [p[:n] for p in pairs]
    return s.createDataFrame(rows, ", ".join(f"c{k} string" for k in range(n)))


#: What each text must become.
PARTIES = [
    ("DEMOCRATIC", "DEM"), ("Democrat", "DEM"), ("DEM", "DEM"), ("d", "DEM"), ("Republican", "REP"), ("REP", "REP"), ("R", "REP"), ("Green", "GRN"), ("GRE", "GRN"),
    ("GRN", "GRN"), ("Libertarian", "LIB"), ("LIB", "LIB"), ("Independent", "IND"), ("IND", "IND"), ("Unaffiliated", "IND"), ("UNA", "IND"), ("Non-Partisan", "NPP"),
    ("Nonpartisan", "NPP"), ("Non Partisan", "NPP"), ("Judicial", "NPP"), ("NPP", "NPP"), ("Constitution", "CON"), ("Working Class", "WCP"), ("Bread and Roses", "BNR"),
    ("Other Candidates", "OTH"), ("Other", "OTH"), ("AIP", "AIP"), ("PPY", "PPY"), ("W", "WRI"), ("PRO", "PRO"), ("Forward", "FOR"), (" rep ", "REP"), (None, None), ("", None),
]
OFFICES = [
    ("U.S. Senator", "US_SENATE", "FEDERAL"), ("United States Senator", "US_SENATE", "FEDERAL"), ("Representative in Congress", "US_HOUSE", "FEDERAL"),
    ("U.S. Representative", "US_HOUSE", "FEDERAL"), ("Governor / Lt. Governor", "GOVERNOR", "STATE"), ("Governor", "GOVERNOR", "STATE"),
    ("Lieutenant Governor", "LT_GOVERNOR", "STATE"), ("Attorney General", "ATTORNEY_GENERAL", "STATE"), ("Comptroller", "COMPTROLLER", "STATE"),
    ("Treasurer", "TREASURER", "STATE"), ("State Senator", "STATE_SENATE", "STATE"), ("House of Delegates", "STATE_HOUSE", "STATE"), ("Delegate", "STATE_HOUSE", "STATE"),
    ("County Executive", "COUNTY_EXEC", "COUNTY"), ("County Council", "COUNTY_COUNCIL", "COUNTY"), ("County Council At Large", "COUNTY_COUNCIL", "COUNTY"),
    ("President of the County Council", "COUNTY_COUNCIL", "COUNTY"), ("County Commissioner", "COUNTY_COMM", "COUNTY"), ("County Commissioner President", "COUNTY_COMM", "COUNTY"),
    ("County Commissioner At Large", "COUNTY_COMM", "COUNTY"), ("Member of the City Council", "CITY_COUNCIL", "CITY"), ("President of the City Council", "CITY_COUNCIL", "CITY"),
    ("Council - City of Cumberland", "CITY_COUNCIL", "CITY"), ("Council - City of Hagerstown", "CITY_COUNCIL", "CITY"), ("Sheriff", "SHERIFF", "COUNTY"),
    ("State's Attorney", "STATES_ATTORNEY", "COUNTY"), ("Register of Wills", "REGISTER_WILLS", "COUNTY"), ("Clerk of the Circuit Court", "CIRCUIT_CLERK", "COUNTY"),
    ("Judge of the Circuit Court", "CIRCUIT_JUDGE", "COUNTY"), ("Judge of the Orphans' Court", "ORPHANS_JUDGE", "COUNTY"), ("Board of Education", "SCHOOL_BOARD", "COUNTY"),
    ("Board of Education At Large", "SCHOOL_BOARD", "COUNTY"), ("Democratic Central Committee", "PARTY_COMM", "COUNTY"), ("Republican Central Committee", "PARTY_COMM", "COUNTY"),
    ("Member of Congress", "US_HOUSE", "FEDERAL"), ("State Senator, District 4", "STATE_SENATE", "STATE"), ("Senator", "US_SENATE", "FEDERAL"),
    ("Delegate to the National Convention", "NATL_DELEGATE", "STATE"), ("Alternate Delegate", "NATL_DELEGATE", "STATE"), ("Delegate, House District 2", "STATE_HOUSE", "STATE"),
    ("Governor of the State", "GOVERNOR", "STATE"), ("City Council District 3", "CITY_COUNCIL", "CITY"), ("county council district 2", "COUNTY_COUNCIL", "COUNTY"),
    ("Town Council", "COUNTY_COUNCIL", "COUNTY"), ("Commissioner", "COUNTY_COMM", "COUNTY"), ("County Sheriff", "SHERIFF", "COUNTY"), ("Judge", "JUDGE", "COUNTY"),
    ("Board of Public Education", "SCHOOL_BOARD", "COUNTY"), ("Clerk of Court", "CLERK", "COUNTY"), ("Register", "REGISTER_WILLS", "COUNTY"), ("County Attorney", "STATES_ATTORNEY", "COUNTY"),
    ("Green Central Committee", "PARTY_COMM", "COUNTY"), ("City Treasurer", "TREASURER", "STATE"), ("Mayor", "MAYOR", "CITY"), ("Mayor of Town", "MAYOR", "CITY"), (None, "OTHER", "COUNTY"), ("", "OTHER", "COUNTY"),
]
COMMITTEE_TYPES = [
    ("Candidate Committee", "CANDIDATE"), ("Political Action Committee", "PAC"), ("Party Central Committee", "PARTY"), ("Ballot Issue Committee", "PAC"),
    ("Independent Expenditure", "SUPER_PAC"), ("Super Political Action Committee", "SUPER_PAC"), ("Inaugural Committee", "OTHER"), ("Slate Committee", "PAC"),
    ("Out-of-State Committee", "PAC"), ("Participating Organization Committee", "PAC"), ("Public Financing Committee", "OTHER"),
    ("Gubernatorial Ticket Committee", "CANDIDATE"), ("Legislative Party Caucus Committee", "PARTY"), ("Something else", "OTHER"), (None, "OTHER"),
]
COUNTIES = [
    ("Baltimore City", None, "Baltimore"), ("City of Baltimore", None, "Baltimore"), ("Montgomery County", "Montgomery", None), ("PRINCE GEORGE'S COUNTY", "Prince George's", None),
    ("Prince George`s", "Prince George's", None), ("Saint Mary's", "St. Mary's", None), ("st. mary's county", "St. Mary's", None), ("queen anne's", "Queen Anne's", None),
    ("ANNE ARUNDEL", "Anne Arundel", None), ("Rockville City", "Rockville City", None), (None, None, None), ("", None, None),
]
DISTRICTS = [
    ("6", "Representative in Congress", "MD-06"), ("Congressional District 3", None, "MD-03"), ("Congressional District 12", "Sheriff", "MD-12"), ("District 123", "U.S. Representative", "MD-123"),
    ("At Large", "Representative in Congress", "At Large"), ("Legislative District 31", None, "31"), ("District 31A", "House of Delegates", "31"), ("31", "State Senator", "31"),
    ("Councilmanic District 4", "County Council", "District 4"), ("Commissioner District 2", None, "District 2"), ("Circuit 7", "Judge of the Circuit Court", "Circuit 7"),
    ("Judicial Circuit 3", None, "Circuit 3"), ("PRINCE GEORGE`S", "Sheriff", "Prince George's"), ("SAINT MARY'S", None, "St. Mary's"), ("anne arundel", "Sheriff", "Anne Arundel"),
    ("District 5", "Sheriff", "District 5"), ("one two three", "Sheriff", "one two three"), (None, "Sheriff", None),
]
COMMITTEE_PEOPLE = [
    ("Friends of John Smith", "JOHN SMITH"), ("John Smith for Governor", "JOHN SMITH"), ("Committee to Elect John Smith", "JOHN SMITH"), ("Citizens for John Smith", "JOHN SMITH"),
    ("Smith (John) for Delegate", "JOHN SMITH"), ("Smith  John Friends of", "JOHN SMITH"), ("Zubairi  Daniel - Personal Treasurer Account", "DANIEL ZUBAIRI"),
    ("Guthrie  Dion F. Citizens to Elect", "DION F GUTHRIE"), ("Arango Millan  Juan (Johnny) for Allegany", "JUAN ARANGO MILLAN"), ("Roe  (Nick) Friends of", "NICK ROE"),
    ("Smith, John for Sheriff", "JOHN SMITH"), ("Re-Elect Ann Lee Campaign", "ANN LEE"), ("Ann Lee for Alaska", "ANN LEE FOR ALASKA"), ("Ann Lee for Our County", "ANN LEE"),
    ("Lee  Ann for Change Committee", "ANN LEE"), ("Lee  Ann Committe", "ANN LEE"), ("Team Ann Lee", "TEAM ANN LEE"), ("Vote for Ann Lee", "ANN LEE"), (None, None), ("", None),
]


@query(f"SELECT c0 AS party, r AS code FROM {_values(PARTIES)} t(c0, r)")
def party_values(s: SparkSession, d: str) -> DataFrame:
    return _inputs(s, PARTIES).select(F.col("c0").alias("party"), codes.party(F.col("c0")).alias("code"))


@query(f"SELECT c0 AS office, r AS code, l AS level FROM {_values(OFFICES)} t(c0, r, l)")
def office_values(s: SparkSession, d: str) -> DataFrame:
    rows = _inputs(s, OFFICES).select(F.col("c0").alias("office"), codes.office(F.col("c0")).alias("code"))
    return rows.withColumn("level", codes.jurisdiction(F.col("code")))


@query(f"SELECT c0 AS kind, r AS code FROM {_values(COMMITTEE_TYPES)} t(c0, r)")
def committee_type_values(s: SparkSession, d: str) -> DataFrame:
    return _inputs(s, COMMITTEE_TYPES).select(F.col("c0").alias("kind"), codes.state_committee_type(F.col("c0")).alias("code"))


@query(f"SELECT c0 AS place, county, city FROM {_values(COUNTIES)} t(c0, county, city)")
def county_values(s: SparkSession, d: str) -> DataFrame:
    return _inputs(s, COUNTIES).select(F.col("c0").alias("place"), codes.county_city(F.col("c0")).alias("j")).select("place", "j.*")


@query(f"SELECT c0 AS district, c1 AS office, r AS code FROM {_values(DISTRICTS)} t(c0, c1, r)")
def district_values(s: SparkSession, d: str) -> DataFrame:
    return _inputs(s, DISTRICTS, 2).select(F.col("c0").alias("district"), F.col("c1").alias("office"), codes.district(F.col("c0"), F.col("c1")).alias("code"))


@query(f"SELECT c0 AS committee, r AS person FROM {_values(COMMITTEE_PEOPLE)} t(c0, r)")
def committee_person_values(s: SparkSession, d: str) -> DataFrame:
    return _inputs(s, COMMITTEE_PEOPLE).select(F.col("c0").alias("committee"), text.candidate_of_committee(F.col("c0")).alias("person"))


_NULL = "CASE WHEN trim({0}) IN ('nan', 'None', '') THEN NULL ELSE trim({0}) END"
_DAY = "CAST(CASE WHEN regexp_full_match(trim({0}), '\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}') THEN try_strptime(trim({0}), '%m/%d/%Y') END AS DATE)"


@query(f"""SELECT ccf_id AS source_ccf_id, {_NULL.format('committee_name')} AS name, committee_type, committee_status AS status,
  coalesce(lower(committee_status) = 'active', false) AS is_active, election_type, {_DAY.format('registered_date')} AS registered_date, {_DAY.format('amended_date')} AS amended_date,
  {_NULL.format('chairperson_name')} AS chairperson_name, {_NULL.format('treasurer_name')} AS treasurer_name, coalesce(citation_violations, '') <> '' AS has_violations, citation_violations
  FROM bronze_md_committee""")
def silver_state_committees(s: SparkSession, d: str) -> DataFrame:
    return pipeline.silver_state_committees(table(s, d, "bronze_md_committee"))


_FULL = r"regexp_replace(trim(concat_ws(' ', candidate_first_name, candidate_last_name)), ',\s*(Jr\.?|Sr\.?|II|III|IV|V|2nd|3rd|4th|5th)$', ' \1')"


@query(f"""SELECT content_hash AS source_content_hash, {_NULL.format(_FULL)} AS name, {_NULL.format('candidate_first_name')} AS first_name, {_NULL.format('candidate_last_name')} AS last_name,
  {_NULL.format('party')} AS party, gender, {_NULL.format('office_name')} AS office, district, jurisdiction, status, coalesce(lower(status) IN ('active', 'seeking the nomination'), false) AS is_active,
  election_year, b.election_type, b.committee_name, m.k AS committee_ccf_id, email, nullif(regexp_replace(phone, '[^0-9]', '', 'g'), '') AS phone, website
  FROM bronze_md_candidate b LEFT JOIN (SELECT committee_name, max(ccf_id) AS k FROM bronze_md_committee GROUP BY 1) m ON m.committee_name = b.committee_name""")
def silver_state_candidates(s: SparkSession, d: str) -> DataFrame:
    return pipeline.silver_state_candidates(table(s, d, "bronze_md_candidate"), table(s, d, "bronze_md_committee"))


@query("""SELECT committee_name AS name, CASE committee_type WHEN 'Candidate Committee' THEN 'CANDIDATE' WHEN 'Political Action Committee' THEN 'PAC' WHEN 'Party Central Committee' THEN 'PARTY'
  WHEN 'Ballot Issue Committee' THEN 'PAC' WHEN 'Slate Committee' THEN 'PAC' ELSE 'OTHER' END AS committee_type, 'MD' AS state, ccf_id AS state_committee_id,
  coalesce(lower(committee_status) = 'active', false) AS is_active FROM (SELECT * REPLACE (CASE WHEN trim(committee_name) IN ('nan', 'None', '') THEN NULL ELSE trim(committee_name) END AS committee_name)
  FROM bronze_md_committee) WHERE ccf_id NOT IN (SELECT state_committee_id FROM gold_committee WHERE state_committee_id IS NOT NULL)""")
def gold_state_committees(s: SparkSession, d: str) -> DataFrame:
    silver = pipeline.silver_state_committees(table(s, d, "bronze_md_committee"))
    return pipeline.gold_state_committees(silver, table(s, d, "gold_committee")).select("name", "committee_type", "state", "state_committee_id", "is_active")


@query("""SELECT content_hash AS state_candidate_id, election_year AS first_election_year, election_year AS last_election_year, coalesce(lower(status) IN ('active', 'seeking the nomination'), false) AS is_active,
  CASE WHEN trim(office_name) IN ('nan', 'None', '') THEN NULL ELSE trim(office_name) END AS office_raw FROM bronze_md_candidate WHERE election_year >= 2022
  AND content_hash NOT IN (SELECT state_candidate_id FROM gold_candidate WHERE state_candidate_id IS NOT NULL)""")
def gold_state_candidates(s: SparkSession, d: str) -> DataFrame:
    silver = pipeline.silver_state_candidates(table(s, d, "bronze_md_candidate"), table(s, d, "bronze_md_committee"))
    gold = pipeline.gold_state_candidates(silver, table(s, d, "gold_candidate"), 2022)
    return gold.select("state_candidate_id", "first_election_year", "last_election_year", "is_active", "office_raw")


@query("""SELECT * FROM (VALUES ('Ann Roe', 'SCHOOL_BOARD', 'CITY', NULL, 'Baltimore', 'DEM', 'h1'), ('Bob Lee', 'COUNTY_COUNCIL', 'COUNTY', 'Kent', NULL, 'REP', 'h2'),
  ('Cy Poe', 'STATE_HOUSE', 'STATE', NULL, NULL, 'GRN', 'h3')) t(name, office, jurisdiction_level, office_county, office_city, party, state_candidate_id)""")
def gold_candidate_values(s: SparkSession, d: str) -> DataFrame:
    silver = s.sql("""select * from values ('h1', 'Ann Roe', 'Board of Education', '', 'Baltimore City', 'Democratic', 2026, true), ('h2', 'Bob Lee', 'County Council', 'District 1', 'Kent County', 'R', 2026, true),
      ('h3', 'Cy Poe', 'House of Delegates', '31', 'Baltimore City', 'GRE', 2026, null), ('h4', 'Di Old', 'Sheriff', '', 'Kent', 'D', 2022, true), ('h5', 'Ed Had', 'Sheriff', '', 'Kent', 'D', 2026, true)
      t(source_content_hash, name, office, district, jurisdiction, party, election_year, is_active)""")
    had = s.sql("select 'h5' state_candidate_id")
    return pipeline.gold_state_candidates(silver, had, 2026).select("name", "office", "jurisdiction_level", "office_county", "office_city", "party", "state_candidate_id")


_FEC_COMMITTEES = "('C1', ' One ', 'H', 'P', 'dem', 'md', 'Town', '212011234', 'nan', array('K1', 'K2'), array(2022, 2026)), ('C1', 'Two', 'H', 'P', 'dem', 'md', 'Town', '21201', null, array('K1'), array(2026)), ('C2', 'None', 'K', 'J', null, 'va', '', 'x', 'T', null, null)"


@query("""SELECT * FROM (VALUES ('C1', ' One ', 'One', NULL, 'DEM', 'MD', '21201', 'K1', 2026), ('C2', 'None', NULL, 'T', NULL, 'VA', NULL, NULL, NULL)) t(source_committee_id, typed, name, treasurer_name, party, state, zip, candidate_id, election_cycle)""".replace("typed, ", "typed, "))
def silver_federal_committee_values(s: SparkSession, d: str) -> DataFrame:
    raw = s.sql(f"select * from values {_FEC_COMMITTEES} t(committee_id, name, committee_type, designation, party, state, city, zip, treasurer_name, candidate_ids, cycles)")
    typed = T.first_by_key(raw, ["committee_id"], ["name"]).select(F.col("committee_id").alias("source_committee_id"), F.col("name").alias("typed"))
    out = pipeline.silver_federal_committees(raw).join(typed, "source_committee_id")
    return out.select("source_committee_id", "typed", "name", "treasurer_name", "party", "state", "zip", "candidate_id", "election_cycle")


@query("SELECT * FROM (VALUES ('C1', 'CANDIDATE', 10), ('C2', 'PAC', NULL)) t(fec_committee_id, committee_type, candidate_id)")
def gold_federal_committee_values(s: SparkSession, d: str) -> DataFrame:
    raw = s.sql(f"select * from values {_FEC_COMMITTEES}, ('C3', 'There', 'H', 'P', null, 'md', null, null, null, null, array(2026)) t(committee_id, name, committee_type, designation, party, state, city, zip, treasurer_name, candidate_ids, cycles)")
    people = s.sql("select * from values (11, 'K1'), (10, 'K1'), (12, null) t(id, fec_candidate_id)")
    gold = pipeline.gold_federal_committees(pipeline.silver_federal_committees(raw), s.sql("select 'C3' fec_committee_id"), people)
    return gold.select("fec_committee_id", "committee_type", "candidate_id")


@query("SELECT * FROM (VALUES ('K1', 'Benjamin L. Cardin', 'US_SENATE', 'FEDERAL', 2026), ('K3', 'Pat McDonald III', 'US_HOUSE', 'FEDERAL', 2026)) t(fec_candidate_id, name, office, jurisdiction_level, first_election_year)")
def gold_federal_candidate_values(s: SparkSession, d: str) -> DataFrame:
    raw = s.sql("""select * from values ('K1', 'CARDIN, BENJAMIN L', 's', 'md', '00', 'dem', array(2024, 2026)), ('K2', 'OLD, ONE', 'H', 'md', '01', 'rep', array(2020)),
      ('K3', 'MCDONALD, PAT III', 'H', 'md', '02', 'rep', array(2026)), ('K3', 'MCDONALD, PAT III', 'H', 'md', '02', 'rep', array(2026)) t(candidate_id, name, office, state, district, party, cycles)""")
    gold = pipeline.gold_federal_candidates(pipeline.silver_federal_candidates(raw), s.sql("select cast(null as string) fec_candidate_id"), 2026)
    return gold.select("fec_candidate_id", "name", "office", "jurisdiction_level", "first_election_year")


@query("SELECT * FROM (VALUES ('a', 2018, 2024), ('b', 2020, 2020)) t(candidate_id, first_year, last_year)")
def json_years_values(s: SparkSession, d: str) -> DataFrame:
    return pipeline.election_span(s.sql("""select * from values ('a', '["2024", "2018", "x"]'), ('a', '[2020]'), ('b', '["2020"]'), ('c', null), ('d', '[]') t(candidate_id, election_years)"""))


@query("SELECT * FROM (VALUES ('own'), ('raw')) t(k)")
def cycle_filter_values(s: SparkSession, d: str) -> DataFrame:
    rows = s.sql("""select * from values ('own', array(2024, 2026), null), ('raw', null, '{"cycles": [2026]}'), ('no', array(2024), '{"cycles": [2022]}'), ('none', null, null) t(k, cycles, raw_json)""")
    return rows.where(pipeline.in_cycle(2026)).select("k")


@query("SELECT * FROM (VALUES (1, 'b'), (2, 'd'), (3, 'x')) t(id, v)")
def upsert_repeated_keys(s: SparkSession, d: str) -> DataFrame:
    target = s.sql("select * from values (1, 'a'), (3, 'x') t(id, v)")
    return T.upsert(target, s.sql("select * from values (1, 'c'), (1, 'b'), (2, 'e'), (2, 'd') t(id, v)"), ["id"], ["v"])


@query("SELECT * FROM (VALUES (1, 'a'), (2, 'd')) t(id, v)")
def insert_repeated_keys(s: SparkSession, d: str) -> DataFrame:
    return T.insert_if_absent(s.sql("select 1 id, 'a' v"), s.sql("select * from values (1, 'c'), (2, 'e'), (2, 'd') t(id, v)"), ["id"])


_NAME = r"trim(upper(regexp_replace(regexp_replace(name, '[,.\-''\"()]', ' ', 'g'), '\s+', ' ', 'g')))"


@query("SELECT * FROM (VALUES (1, 5, 'given'), (2, 10, 'state_id'), (3, 11, 'name'), (4, 12, 'variant'), (5, NULL, NULL)) t(id, candidate_id, link_method)")
def linkage_values(s: SparkSession, d: str) -> DataFrame:
    committees = s.sql("""select * from values (1, 'X', 'PAC', 5, null), (2, 'X', 'CANDIDATE', null, 'S2'), (3, 'Ann Roe', 'CANDIDATE', null, null),
      (4, 'Friends of Bob Lee', 'CANDIDATE', null, null), (5, 'Friends of Nobody', 'CANDIDATE', null, null) t(id, name, committee_type, candidate_id, state_committee_id)""")
    candidates = s.sql("select * from values (10, 'Zed', 'S2'), (11, 'Ann Roe', null), (12, 'Bob Lee', null) t(id, name, state_candidate_id)")
    return linkage.link_committees(committees, candidates).select("id", "candidate_id", "link_method")


def _legacy(keys: str) -> str:
    some = " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
    return f"""SELECT {keys}, count(*) AS n_contributions, CAST(sum(amount) AS DECIMAL(18,2)) AS total_amount FROM gold_contribution
      WHERE source_system = 'FEC' AND source_transaction_id NOT LIKE '%E' AND {some} GROUP BY ALL"""


@query(_legacy("contributor_id"))
def legacy_contributor_stats(s: SparkSession, d: str) -> DataFrame:
    return V.legacy_stats(table(s, d, "gold_contribution"), ["contributor_id"])


@query(_legacy("recipient_candidate_id"))
def legacy_candidate_stats(s: SparkSession, d: str) -> DataFrame:
    return V.legacy_stats(table(s, d, "gold_contribution"), ["recipient_candidate_id"])


@query(_legacy("contributor_id, recipient_committee_id"))
def legacy_contributor_committee_stats(s: SparkSession, d: str) -> DataFrame:
    return V.legacy_stats(table(s, d, "gold_contribution"), ["contributor_id", "recipient_committee_id"])


@query(_legacy("contributor_id, recipient_candidate_id"))
def legacy_contributor_candidate_stats(s: SparkSession, d: str) -> DataFrame:
    return V.legacy_stats(table(s, d, "gold_contribution"), ["contributor_id", "recipient_candidate_id"])


@query("""SELECT source_system, n, no_contributor, no_committee, CASE WHEN (no_contributor + no_committee) / n > 0.1 THEN 'error' WHEN no_contributor + no_committee > 0 THEN 'warning' ELSE 'success' END AS status
  FROM (SELECT f.source_system, count(*) AS n, count(*) FILTER (WHERE c.id IS NULL) AS no_contributor, count(*) FILTER (WHERE m.id IS NULL) AS no_committee FROM gold_contribution f
  LEFT JOIN gold_contributor c ON c.id = f.contributor_id LEFT JOIN gold_committee m ON m.id = f.recipient_committee_id GROUP BY 1)""")
def state_link_status(s: SparkSession, d: str) -> DataFrame:
    from ledgerloom.plans.finance_queries import unresolved_rates

    return quality.link_status(unresolved_rates(s, d), together=True)


@query("""SELECT count(*) FILTER (WHERE content_hash IS NULL) AS missing, count(*) FILTER (WHERE NOT regexp_full_match(content_hash, '[0-9a-f]{64}')) AS malformed,
  (SELECT count(*) FROM (SELECT content_hash FROM bronze_md_contribution WHERE content_hash IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) AS repeated FROM bronze_md_contribution""")
def hash_quality(s: SparkSession, d: str) -> DataFrame:
    return quality.hash_status(table(s, d, "bronze_md_contribution"), "content_hash")


@query("SELECT id, amount FROM gold_contribution WHERE amount IS NOT NULL AND NOT (amount BETWEEN 0 AND 10000)")
def range_check(s: SparkSession, d: str) -> DataFrame:
    return quality.range_failures(table(s, d, "gold_contribution"), "amount", 0, 10000).select("id", "amount")


@query("""SELECT 'bronze' AS part, count(*) AS n FROM bronze_md_contribution UNION ALL SELECT 'silver', count(*) FROM silver_md_contribution
  UNION ALL SELECT 'total', (SELECT count(*) FROM bronze_md_contribution) + (SELECT count(*) FROM silver_md_contribution)""")
def run_summary(s: SparkSession, d: str) -> DataFrame:
    return quality.run_summary({"bronze": table(s, d, "bronze_md_contribution"), "silver": table(s, d, "silver_md_contribution")})


@query("""SELECT recipient_committee_id, contributor_id, total_amount FROM (SELECT *, row_number() OVER (PARTITION BY recipient_committee_id ORDER BY total_amount DESC NULLS LAST, contributor_id) AS k
  FROM (SELECT recipient_committee_id, contributor_id, CAST(sum(amount) AS DECIMAL(18,2)) AS total_amount FROM gold_contribution GROUP BY 1, 2)
  WHERE recipient_committee_id = (SELECT min(recipient_committee_id) FROM gold_contribution)) WHERE k <= 10""")
def ranked_page(s: SparkSession, d: str) -> DataFrame:
    fact = table(s, d, "gold_contribution")
    view = fact.groupBy("recipient_committee_id", "contributor_id").agg(F.sum("amount").cast("decimal(18,2)").alias("total_amount"))
    first = fact.agg(F.min("recipient_committee_id")).first()[0]
    return V.ranked_page(view, "recipient_committee_id", first, 10, tie="contributor_id")


@query("SELECT id, CASE office WHEN 'US_HOUSE' THEN 'U.S. Representative' WHEN 'US_SENATE' THEN 'U.S. Senator' WHEN 'PRESIDENT' THEN 'President of the United States' ELSE office END AS shown FROM gold_candidate")
def readable_office(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "gold_candidate").select("id", codes.readable_office(F.col("office")).alias("shown"))


@query("""SELECT id, CASE WHEN jurisdiction_level = 'COUNTY' THEN office_county END AS office_county, CASE WHEN jurisdiction_level = 'CITY' THEN office_city END AS office_city FROM gold_candidate""")
def place_by_level(s: SparkSession, d: str) -> DataFrame:
    level = F.col("jurisdiction_level")
    return table(s, d, "gold_candidate").select("id", codes.only_at_level(F.col("office_county"), level, "COUNTY").alias("office_county"), codes.only_at_level(F.col("office_city"), level, "CITY").alias("office_city"))


@query("SELECT id FROM gold_committee WHERE id NOT IN (SELECT conduit_committee_id FROM gold_contribution)")
def not_in_with_nulls(s: SparkSession, d: str) -> DataFrame:
    """NOT IN as SQL means it: one null among the keys leaves no row."""
    for name in ("gold_committee", "gold_contribution"):
        table(s, d, name).createOrReplaceTempView(f"ledgerloom_{name}")
    return s.sql("SELECT id FROM ledgerloom_gold_committee WHERE id NOT IN (SELECT conduit_committee_id FROM ledgerloom_gold_contribution)")


@query("""SELECT id, CASE WHEN regexp_matches(contributor_address, '\\b\\d{5}(-\\d{4})?\\s*$') THEN regexp_extract(contributor_address, '\\b(\\d{5})(-\\d{4})?\\s*$', 1) END AS zip,
  nullif(regexp_extract(contributor_address, '\\b([A-Z]{2})\\s+\\d{5}', 1), '') AS state FROM bronze_md_contribution""")
def address_zip_state(s: SparkSession, d: str) -> DataFrame:
    from ledgerloom.functions import parse

    return table(s, d, "bronze_md_contribution").select("id", parse.address(F.col("contributor_address")).alias("a")).select("id", "a.zip", "a.state")


@query("SELECT contribution_type, count(*) AS n FROM gold_contribution GROUP BY 1")
def value_counts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "gold_contribution").groupBy("contribution_type").agg(F.count(F.lit(1)).alias("n"))
