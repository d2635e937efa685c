"""Queries of the finance engine's own operators, each with SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import codes, parse, text
from ledgerloom.operators import tables as T
from ledgerloom.plans import views as V
from ledgerloom.session import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):  # noqa: ANN201
    def register(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def _fact(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "gold_contribution")


_COUNTED = """(SELECT * FROM gold_contribution WHERE source_system <> 'FEC' OR (NOT coalesce(is_earmark_receipt, false)
  AND coalesce(source_transaction_id, '') NOT LIKE '%E' AND upper(coalesce(memo_text, '')) NOT LIKE '%EARMARK%'
  AND upper(coalesce(memo_text, '')) NOT LIKE '%CONDUIT%' AND upper(coalesce(memo_text, '')) NOT LIKE '%ATTRIBUTION BELOW%'))"""
_M = "count(*) AS n_contributions, CAST(sum(amount) AS DECIMAL(18,2)) AS total_amount"
_AVG = "CAST(CAST(sum(amount) AS DECIMAL(18,2)) AS DOUBLE) / count(*) AS avg_amount"
_DAYS = "min(contribution_date) AS first_date, max(contribution_date) AS last_date"
_CAND = f"""(SELECT f.*, coalesce(f.recipient_candidate_id, c.candidate_id) AS cand FROM {_COUNTED} f
  LEFT JOIN gold_committee c ON c.id = f.recipient_committee_id)"""


@query(f"SELECT contributor_id, {_M}, count(DISTINCT recipient_committee_id) AS n_committees, {_DAYS}, {_AVG} FROM {_COUNTED} GROUP BY 1")
def contributor_stats(s: SparkSession, d: str) -> DataFrame:
    return V.contributor_stats(_fact(s, d))


@query(f"SELECT recipient_committee_id, {_M}, count(DISTINCT contributor_id) AS n_contributors, {_AVG} FROM {_COUNTED} GROUP BY 1")
def committee_stats(s: SparkSession, d: str) -> DataFrame:
    return V.committee_stats(_fact(s, d))


@query(f"SELECT contributor_id, recipient_committee_id, {_M}, {_DAYS} FROM {_COUNTED} GROUP BY 1, 2")
def contributor_committee_stats(s: SparkSession, d: str) -> DataFrame:
    return V.contributor_committee_stats(_fact(s, d))


@query(f"SELECT cand AS candidate_id, {_M}, count(DISTINCT contributor_id) AS n_contributors, {_AVG} FROM {_CAND} WHERE cand IS NOT NULL GROUP BY 1")
def candidate_stats_fallback(s: SparkSession, d: str) -> DataFrame:
    return V.candidate_stats(_fact(s, d), table(s, d, "gold_committee"))


@query(f"SELECT contributor_id, cand AS candidate_id, {_M}, {_DAYS} FROM {_CAND} WHERE cand IS NOT NULL GROUP BY 1, 2")
def contributor_candidate_stats(s: SparkSession, d: str) -> DataFrame:
    return V.contributor_candidate_stats(_fact(s, d), table(s, d, "gold_committee"))


@query(f"SELECT source_system, count(*) AS n, CAST(sum(amount) AS DECIMAL(18,2)) AS total FROM {_COUNTED} GROUP BY 1")
def earmark_filter(s: SparkSession, d: str) -> DataFrame:
    return V.counted(_fact(s, d)).groupBy("source_system").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").cast("decimal(18,2)").alias("total"))


@query("""SELECT g.id, g.source_transaction_id IS NOT NULL AND EXISTS (SELECT 1 FROM gold_contribution h WHERE h.source_system = g.source_system
  AND h.source_transaction_id = g.source_transaction_id || 'E') AS is_earmark_receipt FROM gold_contribution g""")
def earmark_mark_exists(s: SparkSession, d: str) -> DataFrame:
    return V.mark_receipts(_fact(s, d)).select("id", "is_earmark_receipt")


@query("""WITH r AS (SELECT source_system, source_transaction_id || 'E' AS tid, min(recipient_committee_id) AS conduit FROM gold_contribution g
  WHERE EXISTS (SELECT 1 FROM gold_contribution h WHERE h.source_system = g.source_system AND h.source_transaction_id = g.source_transaction_id || 'E')
  GROUP BY 1, 2) SELECT f.id, coalesce(f.conduit_committee_id, r.conduit) AS conduit_committee_id FROM gold_contribution f
  LEFT JOIN r ON r.source_system = f.source_system AND r.tid = f.source_transaction_id""")
def conduit_assign(s: SparkSession, d: str) -> DataFrame:
    return V.assign_conduits(_fact(s, d)).select("id", "conduit_committee_id")


@query("""SELECT source_system, count(*) FILTER (WHERE is_earmark_receipt) AS receipts, count(*) FILTER (WHERE source_transaction_id LIKE '%E') AS passed,
  count(*) AS n FROM gold_contribution GROUP BY 1""")
def earmark_distribution_filter_agg(s: SparkSession, d: str) -> DataFrame:
    return _fact(s, d).groupBy("source_system").agg(
        F.count_if("is_earmark_receipt").alias("receipts"), F.count_if(F.col("source_transaction_id").endswith("E")).alias("passed"), F.count(F.lit(1)).alias("n")
    )


_ORG = r"upper(trim(regexp_replace(regexp_replace(coalesce(name, ''), '[,.\-''\"()]', '', 'g'), '\s+', ' ', 'g')))"


@query(f"SELECT {_ORG} AS org, min(id) AS canonical_id, count(*) AS n FROM gold_contributor WHERE entity_type IN ('ORG','COM','PAC') GROUP BY 1 HAVING count(*) > 1")
def org_canonical_min_id(s: SparkSession, d: str) -> DataFrame:
    orgs = table(s, d, "gold_contributor").where(F.col("entity_type").isin("ORG", "COM", "PAC"))
    return orgs.groupBy(text.org_name(F.col("name")).alias("org")).agg(F.min("id").alias("canonical_id"), F.count(F.lit(1)).alias("n")).where("n > 1")


@query("SELECT DISTINCT contributor_name, contributor_city, contributor_state, contributor_zip, employer_name, employer_occupation, contributor_type FROM silver_md_contribution")
def distinct_contributors(s: SparkSession, d: str) -> DataFrame:
    c = ["contributor_name", "contributor_city", "contributor_state", "contributor_zip", "employer_name", "employer_occupation", "contributor_type"]
    return table(s, d, "silver_md_contribution").select(*c).distinct()


@query("SELECT id, content_hash FROM (SELECT id, content_hash, row_number() OVER (PARTITION BY content_hash ORDER BY id) AS k FROM bronze_md_contribution) WHERE k = 1")
def dedup_first_by_key(s: SparkSession, d: str) -> DataFrame:
    return T.first_by_key(table(s, d, "bronze_md_contribution").select("id", "content_hash"), ["content_hash"], ["id"])


@query("SELECT id, content_hash FROM bronze_md_contribution b WHERE NOT EXISTS (SELECT 1 FROM silver_md_contribution s WHERE s.source_content_hash = b.content_hash)")
def new_rows_left_anti(s: SparkSession, d: str) -> DataFrame:
    done = table(s, d, "silver_md_contribution").select(F.col("source_content_hash").alias("content_hash"))
    return T.new_rows(table(s, d, "bronze_md_contribution").select("id", "content_hash"), done, ["content_hash"])


@query("SELECT id FROM gold_committee WHERE id NOT IN (SELECT recipient_committee_id FROM gold_contribution WHERE recipient_committee_id IS NOT NULL)")
def not_in_null_aware(s: SparkSession, d: str) -> DataFrame:
    used = _fact(s, d).where("recipient_committee_id IS NOT NULL").select(F.col("recipient_committee_id").alias("id"))
    return table(s, d, "gold_committee").select("id").join(used.distinct(), "id", "left_anti")


@query("SELECT id, name FROM gold_committee WHERE id IN (SELECT conduit_committee_id FROM gold_contribution)")
def in_subquery_semi(s: SparkSession, d: str) -> DataFrame:
    used = _fact(s, d).select(F.col("conduit_committee_id").alias("id"))
    return table(s, d, "gold_committee").select("id", "name").join(used, "id", "left_semi")


@query("""SELECT f.id, c.id AS contributor_fk, m.id AS committee_fk, k.id AS candidate_fk FROM gold_contribution f JOIN gold_contributor c ON c.id = f.contributor_id
  JOIN gold_committee m ON m.id = f.recipient_committee_id LEFT JOIN gold_candidate k ON k.id = f.recipient_candidate_id""")
def fk_resolution(s: SparkSession, d: str) -> DataFrame:
    f = _fact(s, d).select("id", "contributor_id", "recipient_committee_id", "recipient_candidate_id")
    people = table(s, d, "gold_contributor").select(F.col("id").alias("contributor_fk"))
    groups = table(s, d, "gold_committee").select(F.col("id").alias("committee_fk"))
    runners = table(s, d, "gold_candidate").select(F.col("id").alias("candidate_fk"))
    out = f.join(people, f.contributor_id == people.contributor_fk).join(groups, f.recipient_committee_id == groups.committee_fk)
    return out.join(runners, f.recipient_candidate_id == runners.candidate_fk, "left").select("id", "contributor_fk", "committee_fk", "candidate_fk")


@query("""SELECT f.source_system, count(*) AS n, count(*) FILTER (WHERE c.id IS NULL) AS no_contributor, count(*) FILTER (WHERE m.id IS NULL) AS no_committee
  FROM gold_contribution f LEFT JOIN gold_contributor c ON c.id = f.contributor_id LEFT JOIN gold_committee m ON m.id = f.recipient_committee_id GROUP BY 1""")
def unresolved_rates(s: SparkSession, d: str) -> DataFrame:
    f = _fact(s, d).select("source_system", "contributor_id", "recipient_committee_id")
    people = table(s, d, "gold_contributor").select(F.col("id").alias("contributor_id"), F.lit(1).alias("p"))
    groups = table(s, d, "gold_committee").select(F.col("id").alias("recipient_committee_id"), F.lit(1).alias("g"))
    j = f.join(people, "contributor_id", "left").join(groups, "recipient_committee_id", "left")
    return j.groupBy("source_system").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("p").isNull()).alias("no_contributor"), F.count_if(F.col("g").isNull()).alias("no_committee")
    )


@query(f"""SELECT f.recipient_committee_id, c.name, {_M} FROM gold_contribution f JOIN gold_committee c ON c.id = f.recipient_committee_id GROUP BY 1, 2
  ORDER BY total_amount DESC, recipient_committee_id LIMIT 10""")
def top_recipients(s: SparkSession, d: str) -> DataFrame:
    return V.top_recipients(_fact(s, d), table(s, d, "gold_committee")).select("recipient_committee_id", "name", "n_contributions", "total_amount")


@query(f"SELECT contribution_type, {_M} FROM gold_contribution GROUP BY 1 ORDER BY total_amount DESC, contribution_type ASC NULLS LAST LIMIT 10")
def totals_by_type_topk(s: SparkSession, d: str) -> DataFrame:
    return V.totals_by_type(_fact(s, d))


@query("""SELECT source_system, count(*) AS n, CAST(sum(amount) AS DECIMAL(18,2)) AS total, min(amount) AS least, max(amount) AS most,
  CAST(CAST(sum(amount) AS DECIMAL(18,2)) AS DOUBLE) / count(*) AS avg_amount FROM gold_contribution GROUP BY 1""")
def source_totals(s: SparkSession, d: str) -> DataFrame:
    g = _fact(s, d).groupBy("source_system").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").cast("decimal(18,2)").alias("total"), F.min("amount").alias("least"), F.max("amount").alias("most")
    )
    return g.withColumn("avg_amount", F.col("total").cast("double") / F.col("n"))


@query("""SELECT 'bronze' AS layer, count(*) AS n, count(DISTINCT content_hash) AS n_keys FROM bronze_md_contribution
  UNION ALL SELECT 'silver', count(*), count(DISTINCT source_content_hash) FROM silver_md_contribution
  UNION ALL SELECT 'gold', count(*), count(DISTINCT source_sub_id) FROM gold_contribution""")
def layer_counts_union_all(s: SparkSession, d: str) -> DataFrame:
    parts = [("bronze", "bronze_md_contribution", "content_hash"), ("silver", "silver_md_contribution", "source_content_hash"), ("gold", "gold_contribution", "source_sub_id")]
    frames = [table(s, d, t).agg(F.lit(layer).alias("layer"), F.count(F.lit(1)).alias("n"), F.countDistinct(k).alias("n_keys")) for layer, t, k in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("""SELECT recipient_committee_id, election_cycle, max(contribution_date) AS last_date, arg_max(source_sub_id, (contribution_date, source_sub_id)) AS last_sub_id,
  count(*) AS n FROM gold_contribution GROUP BY 1, 2""")
def latest_per_key(s: SparkSession, d: str) -> DataFrame:
    from ledgerloom.streaming.incremental import extraction_state

    return extraction_state(_fact(s, d))


@query("""SELECT recipient_committee_id, election_cycle, max(contribution_date) - 3 AS start_date FROM gold_contribution GROUP BY 1, 2""")
def lookback_window(s: SparkSession, d: str) -> DataFrame:
    from ledgerloom.streaming.incremental import extraction_state, start_dates

    return start_dates(extraction_state(_fact(s, d)), 3)


@query("SELECT id, amount FROM gold_contribution WHERE id > 100 ORDER BY id LIMIT 50")
def keyset_page(s: SparkSession, d: str) -> DataFrame:
    return T.keyset_page(_fact(s, d).select("id", "amount"), "id", 100, 50)


@query("""WITH src AS (SELECT id, upper(name) AS name, city FROM gold_committee WHERE is_active UNION ALL SELECT id + 1000000000, name, city FROM gold_committee WHERE is_active)
  SELECT t.id, coalesce(s.name, t.name) AS name, t.city FROM (SELECT id, name, city FROM gold_committee) t LEFT JOIN src s ON s.id = t.id
  UNION ALL SELECT id, name, city FROM src WHERE id NOT IN (SELECT id FROM gold_committee)""")
def upsert_merge(s: SparkSession, d: str) -> DataFrame:
    target = table(s, d, "gold_committee").select("id", "name", "city")
    act = table(s, d, "gold_committee").where("is_active")
    source = act.select("id", F.upper("name").alias("name"), "city").unionByName(act.select((F.col("id") + 1000000000).alias("id"), "name", "city"))
    return T.upsert(target, source, ["id"], ["name"])


@query("""SELECT id, name FROM gold_candidate WHERE NOT is_active UNION ALL
  SELECT id, upper(name) FROM gold_candidate WHERE id NOT IN (SELECT id FROM gold_candidate WHERE NOT is_active)""")
def insert_if_absent(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "gold_candidate")
    return T.insert_if_absent(c.where("NOT is_active").select("id", "name"), c.select("id", F.upper("name").alias("name")), ["id"])


@query("SELECT id, name FROM gold_contributor WHERE id NOT IN (SELECT contributor_id FROM contributor_group)")
def delete_where_in(s: SparkSession, d: str) -> DataFrame:
    gone = table(s, d, "contributor_group").select(F.col("contributor_id").alias("id"))
    return T.delete_where_in(table(s, d, "gold_contributor").select("id", "name"), gone, "id")


@query("SELECT event_type, json_extract_string(props, '$.k') AS k, count(*) AS n FROM events GROUP BY 1, 2")
def json_field_filter(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").groupBy("event_type", F.get_json_object("props", "$.k").alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT name, min(y) AS first_year, max(y) AS last_year FROM (SELECT name, unnest([first_election_year, last_election_year]) AS y FROM gold_candidate) WHERE y IS NOT NULL GROUP BY 1")
def explode_array_min_max(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "gold_candidate").select("name", F.explode(F.array("first_election_year", "last_election_year")).alias("y")).where("y IS NOT NULL")
    return c.groupBy("name").agg(F.min("y").alias("first_year"), F.max("y").alias("last_year"))


@query("SELECT id FROM gold_candidate WHERE coalesce(list_contains([first_election_year, last_election_year], 2022), false)")
def array_contains_filter(s: SparkSession, d: str) -> DataFrame:
    hit = F.coalesce(F.array_contains(F.array("first_election_year", "last_election_year"), 2022), F.lit(False))
    return table(s, d, "gold_candidate").where(hit).select("id")


_HASH = ["receiving_committee", "contribution_date", "contributor_name", "contributor_address", "contribution_amount", "contribution_type"]


@query("SELECT id, sha256(" + " || '|' || ".join(f"coalesce({c}, '')" for c in _HASH) + ") AS h FROM bronze_md_contribution")
def content_hash(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "bronze_md_contribution").select("id", parse.content_hash(*[F.col(c) for c in _HASH]).alias("h"))


@query(f"SELECT id, {_ORG} AS org_key FROM gold_contributor")
def org_name_key(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "gold_contributor").select("id", text.org_name(F.col("name")).alias("org_key"))


@query(f"""SELECT id, CASE WHEN coalesce(upper(entity_type) IN ('PAC','COM','ORG','CCM','PTY'), false) THEN 'ORG|' || {_ORG}
  ELSE upper(trim(coalesce(name, ''))) || '|' || upper(trim(coalesce(city, ''))) || '|' || upper(trim(coalesce(state, ''))) || '|' || upper(trim(coalesce(employer, ''))) END AS k
  FROM gold_contributor""")
def contributor_key(s: SparkSession, d: str) -> DataFrame:
    c = F.col
    return table(s, d, "gold_contributor").select("id", text.contributor_key(c("name"), c("city"), c("state"), c("employer"), c("entity_type")).alias("k"))


def _given(c: str, w: str) -> str:
    return f"CASE WHEN coalesce({c}, '') <> '' THEN {w} ELSE 0 END"


@query(f"""SELECT id, CAST(least({_given('name', '0.4')} + {_given('city', '0.2')} + {_given('state', '0.2')} + {_given('employer', '0.1')} + {_given('occupation', '0.1')}, 1.0)
  AS DECIMAL(3,2)) AS confidence FROM gold_contributor""")
def match_confidence(s: SparkSession, d: str) -> DataFrame:
    c = F.col
    return table(s, d, "gold_contributor").select("id", codes.match_confidence(c("name"), c("city"), c("state"), c("employer"), c("occupation")).alias("confidence"))


_TITLE = r"array_to_string(list_transform(regexp_extract_all({0}, '(\p{{L}}+|[^\p{{L}}]+)', 1), lambda x: upper(substr(x, 1, 1)) || lower(substr(x, 2))), '')"


@query(f"SELECT id, {_TITLE.format('name')} AS title FROM gold_contributor WHERE name IS NOT NULL")
def title_case_name(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "gold_contributor").where("name IS NOT NULL").select("id", text.title_case(F.col("name")).alias("title"))


@query()
def fec_name(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "gold_contributor").select("id", text.fec_name(F.col("name")).alias("person"))


@query()
def committee_candidate_name(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "bronze_md_committee").select("ccf_id", text.candidate_of_committee(F.col("committee_name")).alias("person"))


_PARTY = """CASE upper(trim(party)) WHEN 'DEMOCRATIC' THEN 'DEM' WHEN 'DEMOCRAT' THEN 'DEM' WHEN 'REPUBLICAN' THEN 'REP' WHEN 'GREEN' THEN 'GRN' WHEN 'GRE' THEN 'GRN' WHEN 'LIBERTARIAN' THEN 'LIB'
  WHEN 'INDEPENDENT' THEN 'IND' WHEN 'UNAFFILIATED' THEN 'IND' WHEN 'UNA' THEN 'IND' WHEN 'NON-PARTISAN' THEN 'NPP' WHEN 'NONPARTISAN' THEN 'NPP' WHEN 'NON PARTISAN' THEN 'NPP' WHEN 'JUDICIAL' THEN 'NPP'
  WHEN 'CONSTITUTION' THEN 'CON' WHEN 'WORKING CLASS' THEN 'WCP' WHEN 'BREAD AND ROSES' THEN 'BNR' WHEN 'OTHER CANDIDATES' THEN 'OTH' WHEN 'OTHER' THEN 'OTH' WHEN 'D' THEN 'DEM' WHEN 'R' THEN 'REP'
  WHEN 'W' THEN 'WRI' ELSE substr(upper(trim(nullif(party, ''))), 1, 3) END"""


@query(f"SELECT id, {_PARTY} AS code FROM bronze_md_candidate")
def party_code(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "bronze_md_candidate").select("id", codes.party(F.col("party")).alias("code"))


_OFFICE = """CASE trim(office_name) WHEN 'Governor / Lt. Governor' THEN 'GOVERNOR' WHEN 'Lieutenant Governor' THEN 'LT_GOVERNOR' WHEN 'Attorney General' THEN 'ATTORNEY_GENERAL' WHEN 'Comptroller' THEN 'COMPTROLLER'
  WHEN 'Treasurer' THEN 'TREASURER' WHEN 'House of Delegates' THEN 'STATE_HOUSE' WHEN 'Delegate' THEN 'STATE_HOUSE' WHEN 'County Executive' THEN 'COUNTY_EXEC' WHEN 'Clerk of the Circuit Court' THEN 'CIRCUIT_CLERK'
  WHEN 'Judge of the Circuit Court' THEN 'CIRCUIT_JUDGE' WHEN 'Judge of the Orphans'' Court' THEN 'ORPHANS_JUDGE' WHEN 'Democratic Central Committee' THEN 'PARTY_COMM' WHEN 'Republican Central Committee' THEN 'PARTY_COMM'
  WHEN 'Member of the City Council' THEN 'CITY_COUNCIL' WHEN 'President of the City Council' THEN 'CITY_COUNCIL' ELSE CASE
  WHEN regexp_matches(lower(office_name), 'congress|representative') THEN 'US_HOUSE' WHEN lower(office_name) LIKE '%senator%' AND lower(office_name) LIKE '%state%' AND lower(office_name) NOT LIKE 'united%' THEN 'STATE_SENATE'
  WHEN lower(office_name) LIKE '%senator%' THEN 'US_SENATE' WHEN regexp_matches(lower(office_name), 'national convention|alternate delegate') THEN 'NATL_DELEGATE'
  WHEN lower(office_name) LIKE '%delegate%' AND lower(office_name) LIKE '%house%' THEN 'STATE_HOUSE' WHEN lower(office_name) LIKE '%governor%' THEN 'GOVERNOR'
  WHEN regexp_matches(lower(office_name), 'city council|council - city') THEN 'CITY_COUNCIL' WHEN lower(office_name) LIKE '%council%' THEN 'COUNTY_COUNCIL' WHEN lower(office_name) LIKE '%commissioner%' THEN 'COUNTY_COMM'
  WHEN lower(office_name) LIKE '%sheriff%' THEN 'SHERIFF' WHEN lower(office_name) LIKE '%judge%' THEN 'JUDGE' WHEN lower(office_name) LIKE '%board%' AND lower(office_name) LIKE '%education%' THEN 'SCHOOL_BOARD'
  WHEN lower(office_name) LIKE '%clerk%' THEN 'CLERK' WHEN lower(office_name) LIKE '%register%' THEN 'REGISTER_WILLS' WHEN lower(office_name) LIKE '%attorney%' THEN 'STATES_ATTORNEY'
  WHEN lower(office_name) LIKE '%central committee%' THEN 'PARTY_COMM' WHEN lower(office_name) LIKE '%treasurer%' THEN 'TREASURER'
  ELSE coalesce(substr(split_part(regexp_replace(nullif(upper(trim(office_name)), ''), '\\s+', ' ', 'g'), ' ', 1), 1, 20), 'OTHER') END END"""


@query(f"SELECT id, {_OFFICE} AS code FROM bronze_md_candidate")
def office_code(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "bronze_md_candidate").select("id", codes.office(F.col("office_name")).alias("code"))


@query("""SELECT id, CASE WHEN committee_type IN ('Candidate Committee', 'Gubernatorial Ticket Committee') THEN 'CANDIDATE' WHEN committee_type IN ('Party Central Committee', 'Legislative Party Caucus Committee') THEN 'PARTY'
  WHEN committee_type IN ('Political Action Committee', 'Ballot Issue Committee', 'Slate Committee', 'Out-of-State Committee', 'Participating Organization Committee') THEN 'PAC'
  WHEN committee_type IN ('Independent Expenditure', 'Super Political Action Committee') THEN 'SUPER_PAC' ELSE 'OTHER' END AS code FROM bronze_md_committee""")
def committee_type_code(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "bronze_md_committee").select("id", codes.state_committee_type(F.col("committee_type")).alias("code"))


@query("""SELECT id, CASE WHEN office IN ('US_HOUSE', 'US_SENATE', 'PRESIDENT') THEN 'FEDERAL' WHEN office IN ('GOVERNOR', 'LT_GOVERNOR', 'ATTORNEY_GENERAL', 'COMPTROLLER', 'TREASURER', 'STATE_SENATE',
  'STATE_HOUSE', 'NATL_DELEGATE') THEN 'STATE' WHEN office IN ('CITY_COUNCIL', 'MAYOR') THEN 'CITY' ELSE 'COUNTY' END AS level FROM gold_candidate""")
def jurisdiction_level(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "gold_candidate").select("id", codes.jurisdiction(F.coalesce("office", F.lit(""))).alias("level"))


_COUNTIES = """CASE upper({0}) WHEN 'PRINCE GEORGE''S' THEN 'Prince George''s' WHEN 'PRINCE GEORGE`S' THEN 'Prince George''s' WHEN 'SAINT MARY''S' THEN 'St. Mary''s' WHEN 'ST. MARY''S' THEN 'St. Mary''s'
  WHEN 'QUEEN ANNE''S' THEN 'Queen Anne''s' END"""


@query(rf"""WITH n AS (SELECT id, trim(nullif(district, '')) AS t, nullif(regexp_extract(district, '(\d+)', 1), '') AS k, lower(district) AS low, CASE WHEN coalesce(office_name, '') = '' THEN '' ELSE {_OFFICE} END AS o FROM bronze_md_candidate)
  SELECT id, CASE WHEN o = 'US_HOUSE' OR contains(low, 'congressional') THEN coalesce('MD-' || CASE WHEN length(ltrim(k, '0')) < 2 THEN lpad(ltrim(k, '0'), 2, '0') ELSE ltrim(k, '0') END, t)
  WHEN o IN ('STATE_SENATE', 'STATE_HOUSE') OR contains(low, 'legislative') THEN coalesce(k, t)
  WHEN regexp_matches(low, 'councilmanic|commissioner district') THEN coalesce('District ' || k, t) WHEN regexp_matches(low, 'circuit|judicial') THEN coalesce('Circuit ' || k, t)
  ELSE coalesce({_COUNTIES.format('t')}, CASE WHEN k IS NULL AND len(string_split_regex(t, '\s+')) <= 2 THEN {_TITLE.format('t')} END, t) END AS code FROM n""")
def district_code(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "bronze_md_candidate").select("id", codes.district(F.col("district"), F.col("office_name")).alias("code"))


@query(rf"""WITH n AS (SELECT id, trim(nullif(jurisdiction, '')) AS t FROM bronze_md_candidate), m AS (SELECT id, t, trim(regexp_replace(t, '(?i) county$', '')) AS bare FROM n)
  SELECT id, CASE WHEN lower(t) NOT IN ('baltimore city', 'city of baltimore') THEN coalesce({_COUNTIES.format('bare')}, {_TITLE.format('bare')}) END AS county,
  CASE WHEN lower(t) IN ('baltimore city', 'city of baltimore') THEN 'Baltimore' END AS city FROM m""")
def county_city(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "bronze_md_candidate").select("id", codes.county_city(F.col("jurisdiction")).alias("j")).select("id", "j.county", "j.city")


@query("SELECT id, nullif(substr(regexp_replace(zip, '[^0-9]', '', 'g'), 1, 5), '') AS z FROM gold_contributor")
def zip5(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "gold_contributor").select("id", parse.zip5(F.col("zip")).alias("z"))


@query("SELECT id, CASE WHEN length(substr(replace(trim(zip), '-', ''), 1, 5)) >= 5 THEN substr(replace(trim(zip), '-', ''), 1, 5) END AS z FROM gold_contributor")
def zip5_strict(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "gold_contributor").select("id", parse.zip5_strict(F.col("zip")).alias("z"))


_BULK = "CASE WHEN o_orderkey % 5 = 0 THEN '02302024' WHEN o_orderkey % 7 = 0 THEN '123' ELSE strftime(o_orderdate, '%m%d%Y') END"


@query(f"SELECT o_orderkey, CAST(CASE WHEN length({_BULK}) IN (7, 8) THEN try_strptime(lpad({_BULK}, 8, '0'), '%m%d%Y') END AS DATE) AS day FROM orders")
def bulk_date(s: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    typed = F.when(k % 5 == 0, "02302024").when(k % 7 == 0, "123").otherwise(F.date_format("o_orderdate", "MMddyyyy"))
    return table(s, d, "orders").select("o_orderkey", parse.bulk_date(typed).alias("day"))


@query(r"""SELECT id, CAST(CASE WHEN regexp_full_match(trim(contribution_date), '\d{1,2}/\d{1,2}/\d{4}') THEN try_strptime(trim(contribution_date), '%m/%d/%Y') END AS DATE) AS day
  FROM bronze_md_contribution""")
def state_date(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "bronze_md_contribution").select("id", parse.state_date(F.col("contribution_date")).alias("day"))


@query(r"""SELECT id, CASE WHEN regexp_full_match(trim(contribution_amount), '-?\d{1,10}(\.\d{1,2})?') THEN TRY_CAST(trim(contribution_amount) AS DECIMAL(12,2)) END AS amount
  FROM bronze_md_contribution""")
def amount_coerce(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "bronze_md_contribution").select("id", parse.amount(F.col("contribution_amount")).alias("amount"))


@query()
def address_parse(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "bronze_md_contribution").select("id", parse.address(F.col("contributor_address")).alias("a")).select("id", "a.*")


@query(r"SELECT id, coalesce(TRY_CAST(nullif(regexp_extract(filing_period, '(\d{4})', 1), '') AS INTEGER), 2024) AS year FROM bronze_md_contribution")
def filing_year(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "bronze_md_contribution").select("id", parse.filing_year(F.col("filing_period")).alias("year"))


@query("""SELECT count(*) AS n, count(*) FILTER (WHERE contribution_date IS NULL) AS no_date, count(*) FILTER (WHERE contribution_amount IS NULL) AS no_amount,
  count(*) FILTER (WHERE contributor_name IS NULL) AS no_name, count(*) FILTER (WHERE committee_ccf_id IS NULL) AS no_committee FROM silver_md_contribution""")
def required_fields(s: SparkSession, d: str) -> DataFrame:
    from ledgerloom.plans.quality import missing_counts

    c = {"no_date": "contribution_date", "no_amount": "contribution_amount", "no_name": "contributor_name", "no_committee": "committee_ccf_id"}
    return missing_counts(table(s, d, "silver_md_contribution"), c)


@query(r"SELECT id, CASE WHEN regexp_replace(employer_name, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') IN ('nan', 'None', '') THEN NULL ELSE regexp_replace(employer_name, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') END AS employer FROM bronze_md_contribution")
def null_tokens(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "bronze_md_contribution").select("id", text.null_words(F.col("employer_name")).alias("employer"))


@query(r"""SELECT id, regexp_replace(trim(concat_ws(' ', candidate_first_name, candidate_last_name)), ',\s*(Jr\.?|Sr\.?|II|III|IV|V|2nd|3rd|4th|5th)$', ' \1') AS person FROM bronze_md_candidate""")
def full_name_suffix(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "bronze_md_candidate").select("id", text.full_name(F.col("candidate_first_name"), F.col("candidate_last_name")).alias("person"))


@query("SELECT id, nullif(regexp_replace(phone, '[^0-9]', '', 'g'), '') AS digits FROM bronze_md_candidate")
def phone_digits(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "bronze_md_candidate").select("id", text.digits(F.col("phone")).alias("digits"))


@query("""SELECT 'bronze_md_contribution' AS stage, count(*) AS n_in, (SELECT count(*) FROM silver_md_contribution) AS n_out,
  CASE WHEN (SELECT count(*) FROM silver_md_contribution) = 0 THEN 'error' WHEN 1.0 - (SELECT count(*) FROM silver_md_contribution) / count(*) > 0.5 THEN 'warning' ELSE 'success' END AS status
  FROM bronze_md_contribution""")
def quality_report(s: SparkSession, d: str) -> DataFrame:
    from ledgerloom.plans.quality import stage_status

    return stage_status("bronze_md_contribution", table(s, d, "bronze_md_contribution"), table(s, d, "silver_md_contribution"))


@query("""SELECT b.id, min(c.ccf_id) AS ccf_id FROM bronze_md_contribution b LEFT JOIN bronze_md_committee c ON c.committee_name = b.receiving_committee GROUP BY 1""")
def enrich_committee_exact_name(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "bronze_md_committee").groupBy(F.col("committee_name").alias("receiving_committee")).agg(F.min("ccf_id").alias("ccf_id"))
    return table(s, d, "bronze_md_contribution").select("id", "receiving_committee").join(c, "receiving_committee", "left").select("id", "ccf_id")


@query("""WITH k AS (SELECT id AS kid, state_candidate_id, upper(name) AS uname FROM gold_candidate),
  n AS (SELECT uname, min(kid) AS kid FROM k WHERE uname IS NOT NULL GROUP BY 1)
  SELECT c.id, coalesce(c.candidate_id, n.kid) AS candidate_id, CASE WHEN c.candidate_id IS NOT NULL THEN 'given' WHEN n.kid IS NOT NULL THEN 'name' END AS link_method
  FROM gold_committee c LEFT JOIN n ON c.committee_type = 'CANDIDATE' AND n.uname = upper(c.name)""")
def linkage_cascade(s: SparkSession, d: str) -> DataFrame:
    from ledgerloom.plans.linkage import link_by_exact_name

    return link_by_exact_name(table(s, d, "gold_committee"), table(s, d, "gold_candidate"))


@query()
def linkage_four_passes(s: SparkSession, d: str) -> DataFrame:
    from ledgerloom.plans.linkage import link_committees

    return link_committees(table(s, d, "gold_committee"), table(s, d, "gold_candidate"))


@query("SELECT strftime(contribution_date, '%Y-%m') AS month, source_system, count(*) AS n, CAST(sum(amount) AS DECIMAL(18,2)) AS total FROM gold_contribution GROUP BY 1, 2")
def monthly_trend(s: SparkSession, d: str) -> DataFrame:
    g = _fact(s, d).groupBy(F.date_format("contribution_date", "yyyy-MM").alias("month"), "source_system")
    return g.agg(F.count(F.lit(1)).alias("n"), F.sum("amount").cast("decimal(18,2)").alias("total"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_hourly(s: SparkSession, d: str) -> DataFrame:
    from ledgerloom.streaming.incremental import hourly_counts

    return hourly_counts(table(s, d, "events"))


# ---- smaller operators ---------------------------------------------------------------------------------------------


@query("""SELECT id FROM gold_candidate WHERE coalesce(abs(first_election_year - 2024) <= 2, false) OR coalesce(abs(last_election_year - 2024) <= 2, false)""")
def cycle_window_filter(s: SparkSession, d: str) -> DataFrame:
    near = F.coalesce(F.exists(F.filter(F.array("first_election_year", "last_election_year"), lambda y: y.isNotNull()), lambda y: F.abs(y - 2024) <= 2), F.lit(False))
    return table(s, d, "gold_candidate").where(near).select("id")


@query("""SELECT committee_type, count(*) AS n, CAST(count(candidate_id) AS DOUBLE) / count(*) AS linked_rate, CAST(count(party) AS DOUBLE) / count(*) AS party_rate
  FROM gold_committee GROUP BY 1""")
def enrichment_rate(s: SparkSession, d: str) -> DataFrame:
    n = F.count(F.lit(1))
    return table(s, d, "gold_committee").groupBy("committee_type").agg(
        n.alias("n"), (F.count("candidate_id").cast("double") / n).alias("linked_rate"), (F.count("party").cast("double") / n).alias("party_rate")
    )


@query("""SELECT election_cycle, CAST(sum(n) AS DOUBLE) / count(*) AS avg_rows, max(n) AS most_rows, count(*) AS n_committees
  FROM (SELECT election_cycle, recipient_committee_id, count(*) AS n FROM gold_contribution GROUP BY 1, 2) GROUP BY 1""")
def rows_per_committee(s: SparkSession, d: str) -> DataFrame:
    per = _fact(s, d).groupBy("election_cycle", "recipient_committee_id").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("election_cycle").agg(
        (F.sum("n").cast("double") / F.count(F.lit(1))).alias("avg_rows"), F.max("n").alias("most_rows"), F.count(F.lit(1)).alias("n_committees")
    )


@query("""SELECT recipient_committee_id AS committee_id FROM gold_contribution WHERE election_cycle = 2024 AND recipient_committee_id IS NOT NULL
  UNION SELECT conduit_committee_id FROM gold_contribution WHERE election_cycle = 2024 AND conduit_committee_id IS NOT NULL""")
def committee_ids_union(s: SparkSession, d: str) -> DataFrame:
    f = _fact(s, d).where("election_cycle = 2024")
    return f.select(F.explode(F.array("recipient_committee_id", "conduit_committee_id")).alias("committee_id")).where("committee_id IS NOT NULL").distinct()


@query(f"""WITH o AS (SELECT id, {_ORG} AS org FROM gold_contributor WHERE entity_type IN ('ORG','COM','PAC')),
  m AS (SELECT id, min(id) OVER (PARTITION BY org) AS canonical FROM o)
  SELECT f.id, coalesce(m.canonical, f.contributor_id) AS contributor_id FROM gold_contribution f LEFT JOIN m ON m.id = f.contributor_id""")
def canonical_repoint(s: SparkSession, d: str) -> DataFrame:
    from ledgerloom.plans.linkage import repoint_organizations

    return repoint_organizations(_fact(s, d), table(s, d, "gold_contributor")).select("id", "contributor_id")


@query(f"""SELECT recipient_committee_id, {_M} FROM gold_contribution WHERE source_system = 'FEC' AND source_transaction_id NOT LIKE '%E'
  AND upper(coalesce(memo_text, '')) NOT LIKE '%EARMARK%' GROUP BY 1""")
def committee_stats_legacy(s: SparkSession, d: str) -> DataFrame:
    old = (F.col("source_system") == "FEC") & ~F.col("source_transaction_id").endswith("E") & ~F.upper(F.coalesce("memo_text", F.lit(""))).contains("EARMARK")
    return _fact(s, d).where(old).groupBy("recipient_committee_id").agg(F.count(F.lit(1)).alias("n_contributions"), F.sum("amount").cast("decimal(18,2)").alias("total_amount"))


@query(r"""SELECT id, split_part(n, ' ', -1) AS last, CASE WHEN contains(n, ' ') THEN regexp_replace(n, '\s\S+$', '') END AS first
  FROM (SELECT id, regexp_replace(trim(name), '\s+', ' ', 'g') AS n FROM gold_candidate WHERE name IS NOT NULL)""")
def full_name_split(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "gold_candidate").where("name IS NOT NULL").select("id", text.split_full_name(F.col("name")).alias("n"))
    return c.select("id", "n.last", "n.first")


@query()
def silver_state_contributions(s: SparkSession, d: str) -> DataFrame:
    from ledgerloom.plans.pipeline import silver_state_contributions as silver

    return silver(table(s, d, "bronze_md_contribution"), table(s, d, "bronze_md_committee"))


@query("""SELECT event_type, user_id, count(*) AS n, max(ts) AS last_ts, arg_max(event_id, (ts, event_id)) AS last_event FROM events GROUP BY 1, 2""")
def latest_event_per_user(s: SparkSession, d: str) -> DataFrame:
    g = table(s, d, "events").groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("ts", "event_id")).alias("m"))
    return g.select("event_type", "user_id", "n", F.col("m.ts").alias("last_ts"), F.col("m.event_id").alias("last_event"))


@query("""SELECT recipient_committee_id, contributor_id, total, rk FROM (SELECT recipient_committee_id, contributor_id, CAST(sum(amount) AS DECIMAL(18,2)) AS total,
  row_number() OVER (PARTITION BY recipient_committee_id ORDER BY sum(amount) DESC, contributor_id) AS rk FROM gold_contribution GROUP BY 1, 2) WHERE rk <= 3""")
def top_contributors_per_committee(s: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    t = _fact(s, d).groupBy("recipient_committee_id", "contributor_id").agg(F.sum("amount").cast("decimal(18,2)").alias("total"))
    w = Window.partitionBy("recipient_committee_id").orderBy(F.col("total").desc(), F.col("contributor_id").asc_nulls_last())
    return t.withColumn("rk", F.row_number().over(w).cast("long")).where("rk <= 3")
