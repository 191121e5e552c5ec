"""Job-posting tables derived from the order tables, for queries, checks and the benchmark.

An order is a posting, a part name is a skill, a line item links them, the
customer's nation is the country.  Gaps, NULLs and odd text come from attribute
values.  Every table covers all rows of its sources, but for ``v_stored_pay`` and
``v_stored_places``, where absent rows are the point (merges, postings without a place).
Each text is plain SQL that Spark and DuckDB both run; ``{name}`` stands for an input
table or for another derived table.
"""

from pyspark.sql import DataFrame, SparkSession

SQL = {
    "v_jobs": """
        SELECT o_orderkey AS job_id,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
                    ELSE CAST(o_orderdate AS DATE) END AS post_date
        FROM {orders}""",
    "v_skills": """
        SELECT min(p_partkey) + 1 AS skill_id, p_name AS skill_raw,
               CASE WHEN p_name LIKE '%bolt' THEN NULL
                    WHEN p_name LIKE '%ring' THEN upper(p_name)
                    ELSE p_name END AS skill_norm
        FROM {part} GROUP BY p_name""",
    # Parts have few names: named once here, facts join on the part key.
    "v_part_skills": "SELECT p_partkey, skill_id FROM {part} JOIN {v_skills} ON skill_raw = p_name",
    "v_links": """
        SELECT l_orderkey AS job_id, skill_id FROM {lineitem} JOIN {v_part_skills} ON p_partkey = l_partkey""",
    "v_jobs_skills": "SELECT DISTINCT job_id, skill_id FROM {v_links}",
    "v_compensation": """
        SELECT o_orderkey AS job_id,
               CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
                    ELSE CAST(floor(o_totalprice) AS DOUBLE) END AS min,
               CAST(floor(o_totalprice) + 1000 AS DOUBLE) AS max,
               CASE WHEN o_orderpriority = '2-HIGH' THEN 'USD' ELSE NULL END AS currency,
               CASE o_orderstatus WHEN 'F' THEN 'year' WHEN 'O' THEN 'hour' ELSE NULL END AS period,
               CAST(0.8 AS DOUBLE) AS parsed_confidence
        FROM {orders}""",
    # Urgent orders have no stored pay row.
    "v_stored_pay": """
        SELECT * FROM {v_compensation}
        WHERE job_id IN (SELECT o_orderkey FROM {orders} WHERE o_orderpriority <> '1-URGENT')""",
    "v_locations": """
        SELECT o_orderkey AS job_id,
               CASE WHEN c_mktsegment = 'BUILDING' THEN NULL
                    ELSE concat('City ', CAST(c_custkey AS STRING)) END AS city,
               CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE c_mktsegment END AS state,
               CASE WHEN n_regionkey = 2 THEN NULL ELSE n_name END AS country,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(n_nationkey * 1.5 AS DOUBLE) END AS lat,
               CAST(n_nationkey * -2.5 AS DOUBLE) AS lon,
               CAST(0.6 AS DOUBLE) AS geocode_confidence
        FROM {orders} JOIN {customer} ON c_custkey = o_custkey JOIN {nation} ON n_nationkey = c_nationkey""",
    # Customers of one segment have no stored place.
    "v_stored_places": """
        SELECT * FROM {v_locations}
        WHERE job_id IN (SELECT o_orderkey FROM {orders} JOIN {customer} ON c_custkey = o_custkey
                         WHERE c_mktsegment <> 'HOUSEHOLD')""",
    # A place table of the parsed location texts; some places stand twice with other coordinates.
    "v_places_twice": """
        SELECT DISTINCT concat('New City ', CAST(c_custkey AS STRING), ', Ny, Nation_', CAST(n_nationkey AS STRING)) AS place,
               CAST(n_nationkey * 2.5 AS DOUBLE) AS lat, c_acctbal AS lon
        FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey
        UNION ALL SELECT concat('New City ', CAST(c_custkey AS STRING), ', Ny, Nation_', CAST(n_nationkey AS STRING)),
               CASE WHEN c_custkey % 2 = 0 THEN CAST(n_nationkey * 2.5 + 1 AS DOUBLE) END, c_acctbal - 5
        FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey WHERE c_custkey % 3 <> 0""",
    "v_places": """
        SELECT concat('City ', CAST(c_custkey AS STRING), ', ', c_mktsegment, ', ', n_name) AS place,
               CAST(n_nationkey * 3.5 AS DOUBLE) AS lat, c_acctbal AS lon
        FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey""",
    "v_salary_raw": """
        SELECT o_orderkey AS job_id,
               CASE o_orderstatus
                 WHEN 'F' THEN CASE o_orderpriority
                   WHEN '1-URGENT' THEN concat('$', price, 'k-$', price, '.5k/yr')
                   WHEN '2-HIGH' THEN 'USD 70-90/hour'
                   WHEN '3-MEDIUM' THEN concat(price, ' to 75k')
                   WHEN '4-NOT SPECIFIED' THEN '$55,000-$75,000'
                   ELSE concat('£', price, 'k per month') END
                 WHEN 'O' THEN CASE o_orderpriority
                   WHEN '1-URGENT' THEN 'competitive'
                   WHEN '2-HIGH' THEN ''
                   WHEN '3-MEDIUM' THEN NULL
                   WHEN '4-NOT SPECIFIED' THEN concat(price, ' k')
                   ELSE concat('€', price, '.5k') END
                 ELSE CASE o_orderpriority
                   WHEN '1-URGENT' THEN '120000 dollars per annum'
                   WHEN '2-HIGH' THEN '401k plus $100k-$120k yearly'
                   WHEN '3-MEDIUM' THEN '70 to 90 mo'
                   WHEN '4-NOT SPECIFIED' THEN '   '
                   ELSE concat('up to ', price, ' Euro, 13 k bonus') END
               END AS salary_raw
        FROM (SELECT *, CAST(CAST(floor(o_totalprice) AS INT) AS STRING) AS price FROM {orders}) AS priced""",
    "v_location_raw": """
        SELECT o_orderkey AS job_id,
               CASE o_orderstatus
                 WHEN 'F' THEN CASE o_orderpriority
                   WHEN '1-URGENT' THEN concat('new city ', CAST(c_custkey AS STRING), ', NY, ', n_name)
                   WHEN '2-HIGH' THEN 'Remote - US'
                   WHEN '3-MEDIUM' THEN n_name
                   WHEN '4-NOT SPECIFIED' THEN 'ny'
                   ELSE 'winston-salem, NC' END
                 WHEN 'O' THEN CASE o_orderpriority
                   WHEN '1-URGENT' THEN concat('o''fallon ', lower(c_mktsegment), ' | uk')
                   WHEN '2-HIGH' THEN ' , '
                   WHEN '3-MEDIUM' THEN ''
                   WHEN '4-NOT SPECIFIED' THEN NULL
                   ELSE 'X' END
                 ELSE CASE o_orderpriority
                   WHEN '1-URGENT' THEN concat(c_mktsegment, ' | ', n_name)
                   WHEN '2-HIGH' THEN 'London, UK/Remote'
                   WHEN '3-MEDIUM' THEN concat('  ', lower(n_name), ' / DE ')
                   WHEN '4-NOT SPECIFIED' THEN '42'
                   ELSE concat(lower(c_mktsegment), ' park, remotely, ', n_name, ', extra') END
               END AS location_raw
        FROM {orders} JOIN {customer} ON c_custkey = o_custkey JOIN {nation} ON n_nationkey = c_nationkey""",
    "v_dates_raw": """
        SELECT o_orderkey AS job_id,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'not a date' WHEN '2-HIGH' THEN '2025-13-40'
                 WHEN '3-MEDIUM' THEN '' ELSE substr(CAST(o_orderdate AS STRING), 1, 10) END AS post_date
        FROM {orders}""",
    # The same days, the day of the month first.
    "v_dates_dmy": """
        SELECT job_id, CASE WHEN post_date LIKE '____-__-__'
                            THEN concat(substr(post_date, 9, 2), '/', substr(post_date, 6, 2), '/', substr(post_date, 1, 4))
                            ELSE post_date END AS post_date
        FROM {v_dates_raw}""",
    # Places of all four levels: some cities with and some without a state, some states, some countries.
    "v_places_coarse": """
        SELECT concat('City ', CAST(c_custkey AS STRING), ', ', c_mktsegment, ', ', n_name) AS place,
               CAST(n_nationkey * 3.5 AS DOUBLE) AS lat, c_acctbal AS lon
        FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey WHERE c_custkey % 4 = 0
        UNION ALL SELECT concat('City ', CAST(c_custkey AS STRING), ', ', n_name), CAST(n_nationkey * 3.5 + 1 AS DOUBLE), c_acctbal
        FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey WHERE c_custkey % 3 = 0
        UNION ALL SELECT DISTINCT concat(c_mktsegment, ', ', n_name), CAST(n_nationkey * 3.5 + 2 AS DOUBLE), CAST(1.5 AS DOUBLE)
        FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey WHERE c_mktsegment IN ('MACHINERY', 'AUTOMOBILE')
        UNION ALL SELECT n_name, CAST(n_nationkey * 3.5 + 3 AS DOUBLE), CAST(2.5 AS DOUBLE) FROM {nation} WHERE n_nationkey % 5 <> 1""",
    "v_text": "SELECT doc_id AS job_id, text AS description_raw FROM {documents}",
    # Raw dictionary entries: part names in several spellings, some blank.
    "v_part_entries": """
        SELECT p_partkey AS pos,
               CASE p_type WHEN 'ECONOMY' THEN concat('  ', upper(p_name), ' ') WHEN 'SMALL' THEN '   '
                 WHEN 'LARGE' THEN concat(upper(substr(p_name, 1, 1)), substr(p_name, 2))
                 ELSE p_name END AS skill
        FROM {part}""",
}


def frames(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """The named derived tables as DataFrames, keyed by name without the ``v_``."""
    made: dict[str, DataFrame] = {}

    def table(name: str) -> DataFrame:
        if name not in made:
            if name in SQL:
                made[name] = spark.sql(SQL[name], **{n: table(n) for n in _inputs(SQL[name])})
            else:
                made[name] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        return made[name]

    return {name.removeprefix("v_"): table(name) for name in names}


def with_clause(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` that defines the named derived tables and what they need."""
    done: list[str] = []

    def add(name: str) -> None:
        if name in SQL and name not in done:
            for n in _inputs(SQL[name]):
                add(n)
            done.append(name)

    for name in names:
        add(name)
    parts = [f"{n} AS ({SQL[n].format(**{i: i for i in _inputs(SQL[n])})})" for n in done]
    return "WITH " + ",\n".join(parts) + "\n"


def _inputs(sql: str) -> list[str]:
    from string import Formatter

    return list(dict.fromkeys(field for _, field, _, _ in Formatter().parse(sql) if field))
