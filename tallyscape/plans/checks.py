"""For each query, SQL another engine runs on the same tables to check the result.

Written independently of the Spark plans: sums are pivoted with CASE, quantiles and
correlations use the engine's own aggregates, silhouettes are averaged over all pairs.
"""

from __future__ import annotations

# The part types and the wide columns they become.
_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
_COLS = [t.lower() for t in _TYPES]
_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


# Columns of the order lines and their types.
_LINE_COLUMNS = [
    ("l_orderkey", "bigint"),
    ("l_partkey", "bigint"),
    ("l_suppkey", "bigint"),
    ("l_linenumber", "int"),
    ("l_quantity", "double"),
    ("l_extendedprice", "double"),
    ("l_discount", "double"),
    ("l_tax", "double"),
    ("l_returnflag", "string"),
    ("l_linestatus", "string"),
    ("l_shipdate", "timestamp_ntz"),
]


def _each(template: str, items: list[str] = _COLS, sep: str = ", ") -> str:
    return sep.join(template.format(c=i) for i in items)


_SALES = """
sales AS (
    SELECT o_custkey AS entity_id, p_type AS category, CAST(year(o_orderdate) AS INT) AS period,
           CAST(l_quantity AS BIGINT) AS quantity
    FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey
)"""
_LONG = (
    _SALES
    + """,
long AS (
    SELECT entity_id, category, period, CAST(sum(quantity) AS BIGINT) AS measure
    FROM sales GROUP BY entity_id, category, period
)"""
)
_CATEGORIES = """
categories AS (
    SELECT row_number() OVER (ORDER BY category) AS category_id, category
    FROM (SELECT DISTINCT p_type AS category FROM part)
)"""
_ENTITIES = """
entities AS (SELECT c_custkey AS entity_id, c_name AS entity FROM customer)"""
_FACTS = f"""{_LONG}, {_CATEGORIES}, {_ENTITIES},
facts AS (
    SELECT row_number() OVER () AS fact_id,
           entity_id, category_id, period, measure
    FROM long JOIN categories USING (category)
)"""
_WIDE = (
    _SALES
    + ",\nwide AS (SELECT entity_id, "
    + ", ".join(
        f"CAST(coalesce(sum(CASE WHEN category = '{t}' THEN quantity END), 0) AS BIGINT) AS {c}"
        for t, c in zip(_TYPES, _COLS)
    )
    + " FROM sales GROUP BY entity_id)"
)
_SCALED = (
    _WIDE
    + ",\nmoments AS (SELECT "
    + _each("avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}")
    + " FROM wide),\nscaled AS (SELECT entity_id, "
    + _each("CASE WHEN s_{c} = 0 THEN 0.0 ELSE ({c} - m_{c}) / s_{c} END AS {c}")
    + " FROM wide, moments)"
)
_NEAREST = (
    _SCALED
    + """,
centres AS (
    SELECT row_number() OVER (ORDER BY c_mktsegment) - 1 AS cluster_id, """
    + _each("avg({c}) AS c_{c}")
    + """
    FROM scaled JOIN customer ON c_custkey = entity_id GROUP BY c_mktsegment
),
distances AS (
    SELECT entity_id, cluster_id, """
    + _each("pow({c} - c_{c}, 2)", sep=" + ")
    + """ AS distance
    FROM scaled, centres
),
nearest AS (
    SELECT entity_id, CAST(cluster_id AS INT) AS cluster_id, distance FROM distances
    QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY distance, cluster_id) = 1
),
assignment AS (
    SELECT c_name AS entity, cluster_id FROM nearest JOIN customer ON c_custkey = entity_id
)"""
)
_CLUSTERED = (
    _NEAREST
    + """,
clustered AS (
    SELECT c_name AS entity, """
    + _each("{c}")
    + """, cluster_id
    FROM wide JOIN nearest USING (entity_id) JOIN customer ON c_custkey = entity_id
)"""
)
_GAPPY = """
gappy AS (
    SELECT l_orderkey, l_linenumber, l_quantity AS quantity,
           CASE WHEN l_quantity < 45 THEN l_quantity END AS l_quantity,
           CASE WHEN l_discount <> 0 THEN l_discount END AS l_discount,
           CASE WHEN l_tax = 0 THEN CAST('NaN' AS DOUBLE) ELSE l_tax END AS l_tax,
           CASE WHEN l_linenumber > 2 THEN l_returnflag END AS l_returnflag
    FROM lineitem
),
known AS (
    SELECT l_orderkey, l_linenumber, quantity, l_quantity, l_discount,
           CASE WHEN NOT isnan(l_tax) THEN l_tax END AS l_tax, l_returnflag
    FROM gappy
)"""
_UNTIDY = r"""
untidy AS (
    SELECT p_partkey,
           CASE p_size WHEN 1 THEN NULL WHEN 2 THEN '   ' WHEN 3 THEN '' WHEN 4 THEN ' Section '
                ELSE '  ' || replace(p_name, ' ', ' ' || chr(9) || '   ') || chr(9) || ' ' END AS name
    FROM part
),
tidy AS (SELECT p_partkey, regexp_replace(trim(name), '\s+', ' ', 'g') AS name FROM untidy)"""
_PAIRS = """
vectors AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
means AS (
    SELECT label, list(m ORDER BY i) AS c FROM (
        SELECT label, i, avg(v[i]) AS m FROM vectors, range(1, 65) AS r(i) GROUP BY label, i
    ) GROUP BY label
)"""


def _square(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda p: pow(p[1] - p[2], 2)))"


def _silhouette_from(pairs: str) -> str:
    """From all (id, own, other, sum of squared distances, size): the score per id."""
    return f"""
{pairs},
per_cluster AS (
    SELECT id, own, other, sum(d) AS total, count(*) AS n FROM pairs GROUP BY id, own, other
),
ab AS (
    SELECT id, own,
           max(CASE WHEN own = other THEN n END) AS own_n,
           max(CASE WHEN own = other AND n > 1 THEN total / (n - 1) END) AS a,
           min(CASE WHEN own <> other THEN total / n END) AS b
    FROM per_cluster GROUP BY id, own
),
scores AS (
    SELECT id, own, CASE WHEN own_n = 1 THEN 0.0 ELSE (b - a) / greatest(a, b) END AS silhouette FROM ab
)"""


_NEAREST_PAIRS = (
    _NEAREST
    + ",\nboth_sides AS (SELECT entity_id, cluster_id, "
    + _each("{c}")
    + " FROM scaled JOIN nearest USING (entity_id))"
    + _silhouette_from(
        ",\npairs AS (SELECT x.entity_id AS id, x.cluster_id AS own, y.cluster_id AS other, "
        + _each("pow(x.{c} - y.{c}, 2)", sep=" + ")
        + " AS d FROM both_sides x, both_sides y)"
    ).lstrip("\n")
)


def _describe(c: str, table: str) -> str:
    return f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean,
        round(stddev_samp({c}), 6) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS q25,
        round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, max({c}) AS max
        FROM {table}"""


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _correlations() -> str:
    pairs = [
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation FROM lineitem"
        for i, a in enumerate(_MEASURES)
        for b in _MEASURES[i + 1 :]
    ]
    flat = [f"SELECT '{a}', 'flat', CAST(NULL AS DOUBLE)" for a in _MEASURES]
    return " UNION ALL ".join(pairs + flat)


def _mode(c: str) -> str:
    return f"(SELECT {c} FROM known WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


def _impute(value: str) -> str:
    filled = ", ".join(
        f"round(coalesce({c}, {value.format(c=c)}), 6) AS {c}" for c in ["l_quantity", "l_discount", "l_tax"]
    )
    return f"WITH {_GAPPY} SELECT l_orderkey, l_linenumber, quantity, {filled}, l_returnflag FROM known"


def _outliers(lower: str, upper: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT entity_id, '{c}' AS column_name, CAST({c} AS DOUBLE) AS value,
        round({lower.format(c=c)}, 6) AS lower, round({upper.format(c=c)}, 6) AS upper
        FROM wide, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3,
                           avg({c}) AS m, stddev_samp({c}) AS s FROM wide)
        WHERE {c} < {lower.format(c=c)} OR {c} > {upper.format(c=c)}"""
        for c in _COLS
    )


_TOP5 = f"""WITH {_FACTS}
SELECT entity, CAST(sum(measure) AS BIGINT) AS total
FROM facts JOIN entities USING (entity_id) JOIN categories USING (category_id)
WHERE category = 'PROMO' AND period = (SELECT max(period) FROM facts)
GROUP BY entity ORDER BY total DESC, entity LIMIT 5"""


def _digests(rows: str, columns: list[str]) -> str:
    """Rows and digest of each period: sums of the halves of the rows' MD5, under MD5 again."""
    text = " || '|' || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns)
    half = "CAST(sum(CAST('0x' || substr(d, {}, 15) AS BIGINT)) AS VARCHAR)"
    return f"""SELECT CAST(period AS INT) AS period, count(*) AS rows,
        md5(CAST(count(*) AS VARCHAR) || ':' || {half.format(1)} || ':' || {half.format(16)}) AS digest
        FROM (SELECT period, md5({text}) AS d FROM ({rows})) GROUP BY period"""


CHECKS: dict[str, str] = {
    "scan_count": "SELECT count(*) AS rows FROM lineitem",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS record_count FROM {t}" for t in _TABLES
    ),
    "table_digests": _digests(
        "SELECT year(o_orderdate) AS period, o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders",
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"],
    ),
    "period_reload": _digests(
        """SELECT o_custkey AS entity_id, p_type AS category, period, CAST(measure * CASE WHEN period = max(period) OVER () THEN 2 ELSE 1 END AS BIGINT) AS measure
        FROM (SELECT o_custkey, p_type, CAST(year(o_orderdate) AS INT) AS period, sum(CAST(l_quantity AS BIGINT)) AS measure FROM lineitem
        JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL)""",
        ["entity_id", "category", "measure"],
    ),
    "distinct_by_sketch": """SELECT p_type AS category, count(DISTINCT o_custkey) AS customers, TRUE AS within FROM lineitem
        JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey GROUP BY p_type""",
    "existing_table_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS record_count FROM {t}"
        for t in ["customer", "nation", "orders", "part"]
    ),
    "project_rename": "SELECT o_orderkey AS order_key, o_custkey AS customer, o_totalprice AS order_total FROM orders",
    "add_column": """SELECT l_orderkey, l_linenumber + 1 AS l_linenumber, l_quantity, round(l_discount, 6) AS l_discount,
        round(l_quantity * (1 - l_discount), 6) AS net_quantity FROM lineitem""",
    "equality_filter": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""",
    "in_filter": """SELECT o_orderkey, o_orderpriority, o_custkey AS c_custkey FROM orders
        WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
          AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
    "first_n_values": """SELECT p_partkey, p_type, p_retailprice FROM part
        WHERE p_type IN (SELECT DISTINCT p_type FROM part ORDER BY p_type LIMIT 3)""",
    "preview_rows": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10",
    "clean_names": f"WITH {_UNTIDY} SELECT p_partkey, name FROM tidy",
    "valid_keys": f"WITH {_UNTIDY} SELECT p_partkey, name FROM tidy WHERE trim(name) <> '' AND name <> 'Section'",
    "missing_names": f"""WITH {_UNTIDY} SELECT count(*) AS missing_names FROM tidy
        WHERE name IS NULL OR trim(name) = '' OR name = 'Section'""",
    "null_profile": f"WITH {_GAPPY} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing FROM known"
        for c in ["l_quantity", "l_discount", "l_tax", "l_returnflag"]
    ),
    "table_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({i} AS INT) AS position, '{kind}' AS type, count(*) AS rows, "
        f"count({c}) AS present FROM lineitem"
        for i, (c, kind) in enumerate(_LINE_COLUMNS)
    ),
    "drop_empty_columns": f"WITH {_GAPPY} SELECT * EXCLUDE (l_tax) FROM gappy",
    "fill_zero": f"""WITH {_GAPPY} SELECT l_orderkey, l_linenumber, quantity, coalesce(l_quantity, 0) AS l_quantity,
        coalesce(l_discount, 0) AS l_discount, coalesce(l_tax, 0) AS l_tax, l_returnflag FROM known""",
    "drop_nulls": f"""WITH {_GAPPY} SELECT * FROM known WHERE l_quantity IS NOT NULL
        AND l_discount IS NOT NULL AND l_tax IS NOT NULL AND l_returnflag IS NOT NULL""",
    "impute_mean": _impute("(SELECT avg({c}) FROM known)"),
    "impute_median": _impute("(SELECT quantile_cont({c}, 0.5) FROM known)"),
    "impute_mode": f"WITH {_GAPPY} SELECT l_orderkey, l_linenumber, quantity, "
    + ", ".join(
        f"coalesce({c}, {_mode(c)}) AS {c}" for c in ["l_quantity", "l_discount", "l_tax", "l_returnflag"]
    )
    + " FROM known",
    "duplicate_count": """SELECT (SELECT count(*) FROM lineitem) - count(*) AS duplicate_rows FROM (
        SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_discount FROM lineitem)""",
    "drop_duplicates": "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_discount FROM lineitem",
    "distinct_values": "SELECT DISTINCT l_partkey FROM lineitem",
    "wide_pivot": f"WITH {_WIDE} SELECT * FROM wide",
    "long_unpivot": f"WITH {_WIDE} "
    + " UNION ALL ".join(f"SELECT entity_id, '{c}' AS category, {c} AS measure FROM wide" for c in _COLS),
    "row_total": f"WITH {_WIDE} SELECT entity_id, {' + '.join(_COLS)} AS total FROM wide",
    "top10_total": f"""WITH {_WIDE} SELECT entity_id, {' + '.join(_COLS)} AS total FROM wide
        ORDER BY total DESC, entity_id LIMIT 10""",
    "long_route_pivot": f"WITH {_LONG} SELECT entity_id, "
    + ", ".join(
        f"CAST(coalesce(sum(CASE WHEN category = '{t}' THEN measure END), 0) AS BIGINT) AS {c}"
        for t, c in zip(_TYPES, _COLS)
    )
    + " FROM long GROUP BY entity_id",
    "reconcile_totals": f"WITH {_WIDE} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, body_sum, stated_total, body_sum = stated_total AS agrees FROM
        (SELECT CAST(sum({c}) AS BIGINT) AS body_sum FROM wide),
        (SELECT CAST(sum(l_quantity) AS BIGINT) AS stated_total FROM lineitem JOIN part ON p_partkey = l_partkey
         WHERE p_type = '{t}')"""
        for t, c in zip(_TYPES, _COLS)
    ),
    "dimension_keys": """SELECT row_number() OVER (ORDER BY c_name) AS entity_id, c_name
        FROM (SELECT DISTINCT c_name FROM customer)""",
    "keys_kept": """
        WITH early AS (
            SELECT DISTINCT c_name FROM customer JOIN orders ON o_custkey = c_custkey WHERE year(o_orderdate) <= 1995),
        late AS (SELECT c_name FROM customer EXCEPT SELECT c_name FROM early),
        first AS (SELECT row_number() OVER (ORDER BY c_name) AS id, c_name FROM early)
        SELECT id AS entity_id, c_name, id AS first_id FROM first
        UNION ALL
        SELECT (SELECT count(*) FROM first) + row_number() OVER (ORDER BY c_name), c_name, NULL FROM late""",
    "fact_load": f"WITH {_WIDE}, {_CATEGORIES}, long AS ("
    + " UNION ALL ".join(f"SELECT entity_id, '{t}' AS category, {c} AS measure FROM wide" for t, c in zip(_TYPES, _COLS))
    + """) SELECT row_number() OVER (ORDER BY entity_id, category_id) AS fact_id, entity_id, category_id, measure,
        CAST(2024 AS INT) AS period FROM long JOIN categories USING (category)""",
    "seed_ignore_existing": f"""WITH {_CATEGORIES} SELECT * FROM categories UNION ALL
        SELECT (SELECT max(category_id) FROM categories) + row_number() OVER (ORDER BY name), name
        FROM (SELECT DISTINCT name FROM (VALUES ('PROMO'), ('ZINC'), ('STANDARD'), ('BRASS'), ('ZINC')) v(name)
              WHERE name NOT IN (SELECT category FROM categories))""",
    "fk_violations": """SELECT o_custkey, o_orderkey FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0)""",
    "fk_valid": """SELECT o_custkey, o_orderkey FROM orders
        WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0)""",
    "apply_defaults": """SELECT doc_id AS fact_id, doc_id AS entity_id, CAST(toxic AS BIGINT) AS category_id,
        CAST(coalesce(quality, 0) AS BIGINT) AS measure, CAST(2024 AS INT) AS period
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "fact_rejects": f"WITH {_WIDE}, {_CATEGORIES}, long AS ("
    + " UNION ALL ".join(f"SELECT entity_id, '{c}' AS column_name, {c} AS measure FROM wide" for c in _COLS)
    + """), known AS (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
        SELECT entity_id AS entity, column_name, CAST(2024 AS INT) AS period, measure,
               CASE WHEN entity_id NOT IN (SELECT c_custkey FROM known) THEN 'entity' ELSE 'category' END AS missing
        FROM long WHERE entity_id NOT IN (SELECT c_custkey FROM known) OR column_name = 'promo'""",
    "fk_null_kept": """SELECT l.doc_id AS label_id, d.doc_id FROM documents d LEFT JOIN labels l USING (doc_id)
        WHERE l.doc_id IS NULL OR l.toxic = 0""",
    "null_profile_labels": """SELECT 'doc_id' AS column_name, count(*) - count(doc_id) AS missing FROM documents
        UNION ALL SELECT 'n_chars', count(*) - count(n_chars) FROM documents
        UNION ALL SELECT 'quality', count(*) - count(quality) FROM documents LEFT JOIN labels USING (doc_id)
        UNION ALL SELECT 'toxic', count(*) - count(toxic) FROM documents LEFT JOIN labels USING (doc_id)""",
    "impute_labels": """SELECT doc_id, round(coalesce(quality, (SELECT avg(quality) FROM labels)), 6) AS quality,
        round(coalesce(toxic, (SELECT avg(toxic) FROM labels)), 6) AS toxic
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "fill_labels": """SELECT doc_id, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "drop_unlabelled": "SELECT doc_id, lang, quality FROM documents JOIN labels USING (doc_id)",
    "long_route_incomplete": "SELECT source, "
    + ", ".join(
        f"CAST(coalesce(sum(CASE WHEN lang = '{c}' THEN quality END), 0) AS BIGINT) AS {c}" for c in ("de", "en", "es", "fr")
    )
    + " FROM documents JOIN labels USING (doc_id) GROUP BY source",
    "left_report_unmatched": """SELECT 'document ' || doc_id AS entity, lang AS cluster_id,
        count(l.quality) AS facts, CAST(sum(l.quality) AS BIGINT) AS total
        FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY doc_id, lang""",
    "kmeans_totals": f"WITH {_WIDE} SELECT count(*) AS rows, " + _each("CAST(sum({c}) AS BIGINT) AS {c}") + " FROM wide",
    "kmeans_fixed_point": "SELECT 0 AS misplaced",
    "sweep_shape": "SELECT 2 AS least, 8 AS most, 7 AS tried, 1 AS best, true AS \"right\"",
    "default_value": f"WITH {_GAPPY} SELECT l_orderkey, l_linenumber, coalesce(l_returnflag, '?') AS flag FROM known",
    "sum_by_period": f"WITH {_LONG} SELECT period, CAST(sum(measure) AS BIGINT) AS total FROM long GROUP BY period",
    "sum_by_category": f"""WITH {_LONG} SELECT category, CAST(sum(measure) AS BIGINT) AS total FROM long
        GROUP BY category ORDER BY total DESC, category LIMIT 10""",
    "sum_by_entity": f"""WITH {_LONG} SELECT entity_id, CAST(sum(measure) AS BIGINT) AS total FROM long
        GROUP BY entity_id ORDER BY total DESC, entity_id LIMIT 10""",
    "avg_by_category_period": f"""WITH {_FACTS} SELECT category, period, round(avg(measure), 6) AS average
        FROM facts JOIN categories USING (category_id) GROUP BY category, period""",
    "top5_latest_period": _TOP5,
    "sql_top5_latest_period": _TOP5,
    "stored_top5_latest_period": _TOP5,
    "stored_entity_totals": f"""WITH {_FACTS}
        SELECT c_name AS entity, c_mktsegment AS cluster_id, count(measure) AS facts, CAST(sum(measure) AS BIGINT) AS total
        FROM customer LEFT JOIN facts ON entity_id = c_custkey GROUP BY c_name, c_mktsegment""",
    "footer_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS rows, count({c}) AS present, "
        f"CAST(min({c}) AS BIGINT) AS least, CAST(max({c}) AS BIGINT) AS greatest FROM lineitem"
        for c, _ in _LINE_COLUMNS[:4]
    ),
    "cluster_sizes": f"WITH {_NEAREST} SELECT cluster_id, count(*) AS members FROM assignment GROUP BY cluster_id",
    "entities_per_cluster": f"""WITH {_NEAREST}, twice AS (SELECT * FROM assignment UNION ALL SELECT * FROM assignment)
        SELECT cluster_id, count(DISTINCT entity) AS entities FROM twice GROUP BY cluster_id""",
    "assignment_pairs": f"""WITH {_NEAREST} SELECT cluster_id, entity, count(*) AS rows FROM assignment
        GROUP BY cluster_id, entity ORDER BY cluster_id, entity LIMIT 20""",
    "members_sorted": f"WITH {_NEAREST} SELECT cluster_id, entity FROM assignment ORDER BY cluster_id, entity",
    "assignment_by_name": f"""WITH {_NEAREST}, {_ENTITIES} SELECT entity, cluster_id
        FROM entities JOIN assignment USING (entity) ORDER BY cluster_id, entity LIMIT 10""",
    "category_totals_in_cluster": f"""WITH {_NEAREST}, {_FACTS.replace(_SALES + ",", "", 1)}
        SELECT category, CAST(sum(measure) AS BIGINT) AS total FROM facts JOIN categories USING (category_id)
        JOIN entities USING (entity_id) JOIN assignment USING (entity)
        WHERE cluster_id = 0 GROUP BY category HAVING sum(measure) > 0""",
    "entity_cluster_report": f"""WITH {_NEAREST}, {_FACTS.replace(_SALES + ",", "", 1)},
        known AS (SELECT * FROM facts)
        SELECT entity, cluster_id, count(fact_id) AS facts, CAST(sum(measure) AS BIGINT) AS total
        FROM assignment JOIN entities USING (entity) LEFT JOIN known USING (entity_id)
        GROUP BY entity, cluster_id""",
    "wide_by_cluster": f"WITH {_CLUSTERED} SELECT * FROM clustered",
    "cluster_stats": f"WITH {_CLUSTERED} SELECT cluster_id, count(*) AS size, "
    + _each(
        "round(avg({c}), 6) AS {c}_mean, min({c}) AS {c}_min, max({c}) AS {c}_max, "
        "CAST(sum({c}) AS BIGINT) AS {c}_sum"
    )
    + " FROM clustered GROUP BY cluster_id",
    "burden_labels": f"""WITH {_CLUSTERED}, ranked AS (
        SELECT cluster_id, avg({' + '.join(_COLS)}) AS mean_total,
               CAST(dense_rank() OVER (ORDER BY avg({' + '.join(_COLS)}) DESC) AS INT) AS rank
        FROM clustered GROUP BY cluster_id)
        SELECT cluster_id, round(mean_total, 6) AS mean_total, rank,
               CASE WHEN rank = 1 THEN 'high' WHEN rank = max(rank) OVER () THEN 'low' ELSE 'medium' END AS burden
        FROM ranked""",
    "bi_export": f"WITH {_CLUSTERED} SELECT *, {' + '.join(_COLS)} AS total FROM clustered",
    "cluster_balance": f"""WITH {_NEAREST}, sizes AS (
        SELECT cluster_id, count(*) AS size, count(*) / sum(count(*)) OVER () AS share FROM assignment GROUP BY cluster_id)
        SELECT cluster_id, size, round(CAST(share AS DOUBLE), 6) AS share, CASE WHEN share < 0.15 THEN 'too small'
               WHEN share > 0.22 THEN 'too large' ELSE 'ok' END AS verdict FROM sizes""",
    "min_max": f"WITH {_WIDE} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, min({c}) AS min, max({c}) AS max FROM wide"
        for c in _COLS
    ),
    "describe": " UNION ALL ".join(_describe(c, "lineitem") for c in _MEASURES),
    "correlation": _correlations(),
    "outliers_iqr": f"WITH {_WIDE} " + _outliers("q1 - 1.5 * (q3 - q1)", "q3 + 1.5 * (q3 - q1)"),
    "outliers_zscore": f"WITH {_WIDE} " + _outliers("m - 2.5 * s", "m + 2.5 * s"),
    "numeric_violations": f"WITH {_GAPPY} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(CASE WHEN {c} - {shift} < 0 THEN 1 END) AS negative,
        count(*) - count({c}) AS missing FROM known"""
        for c, shift in [("l_quantity", 10), ("l_discount", 0), ("l_tax", 0)]
    ),
    "minmax_scaled": f"WITH {_WIDE}, limits AS (SELECT "
    + _each("min({c}) AS lo_{c}, max({c}) AS hi_{c}")
    + " FROM wide) SELECT entity_id, "
    + _each("round(CAST({c} - lo_{c} AS DOUBLE) / (hi_{c} - lo_{c}), 6) AS {c}")
    + ", CAST(0 AS DOUBLE) AS flat FROM wide, limits",
    "standardised": f"WITH {_SCALED} SELECT entity_id, "
    + _each("round({c}, 6) AS {c}")
    + ", CAST(0 AS DOUBLE) AS flat FROM scaled",
    "nearest_centre": f"WITH {_NEAREST} SELECT entity_id, cluster_id, round(distance, 6) AS distance FROM nearest",
    "nearest_label_centre": f"""WITH {_PAIRS} SELECT vec_id, vectors.label AS label, means.label AS cluster_id,
        round({_square('v', 'c')}, 6) AS distance FROM vectors, means
        QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY {_square('v', 'c')}, means.label) = 1""",
    "within_cluster_cost": f"""WITH {_PAIRS} SELECT label AS cluster_id, count(*) AS size,
        round(sum({_square('v', 'c')}), 6) AS cost FROM vectors JOIN means USING (label) GROUP BY label""",
    "cost_to_centres": f"WITH {_NEAREST} SELECT count(*) AS rows, round(sum(distance), 4) AS cost FROM nearest",
    "silhouette": f"WITH {_PAIRS},"
    + _silhouette_from(
        f"pairs AS (SELECT x.vec_id AS id, x.label AS own, y.label AS other, {_square('x.v', 'y.v')} AS d "
        "FROM vectors x, vectors y)"
    )
    + " SELECT id AS vec_id, own AS label, round(silhouette, 6) AS silhouette FROM scores",
    "silhouette_by_cluster": f"""WITH {_NEAREST_PAIRS}
        SELECT own AS cluster_id, round(avg(silhouette), 6) AS silhouette FROM scores GROUP BY own""",
    "silhouette_gate": f"""WITH {_NEAREST_PAIRS}
        SELECT round(avg(silhouette), 6) AS silhouette, avg(silhouette) >= 0.3 AS passes FROM scores""",
}
