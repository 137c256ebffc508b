"""Independent SQL (DuckDB dialect) for every query with an exact answer.

The driver registers the parquet tables as views; the analysis views of
``plans.views`` are re-declared here as CTEs so both engines start from the same rows.
Floating results are rounded to 6 places on both sides.
"""

from __future__ import annotations

VIEW_SQL = {
    "linkage_like": """
        SELECT l_orderkey AS id_1, l_partkey AS id_2,
               l_discount * 10 + 0.0 AS cmp_a, l_tax * 10 + 0.0 AS cmp_b,
               CASE WHEN l_linenumber % 3 = 0 THEN NULL
                    WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS cmp_c,
               CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS cmp_d,
               l_returnflag = 'R' AS is_match
        FROM lineitem""",
    "plays": """
        SELECT CAST(o_custkey AS INTEGER) AS "user", CAST(l_partkey AS INTEGER) AS artist,
               CAST(l_quantity AS INTEGER) AS "count"
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "items": """
        SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS name FROM part""",
    "alias_pairs": """
        SELECT CAST(p_partkey AS INTEGER) AS artist, CAST(p_partkey - 9 AS INTEGER) AS alias
        FROM part WHERE p_partkey % 10 = 9""",
    "labelled": """
        SELECT l_orderkey, l_linenumber,
               CAST(l_quantity AS DOUBLE) AS q, CAST(l_extendedprice AS DOUBLE) AS e,
               CAST(l_discount AS DOUBLE) AS d, CAST(l_tax AS DOUBLE) AS t,
               CAST(floor(l_extendedprice / l_quantity) AS DOUBLE) AS u,
               CAST(l_linenumber AS DOUBLE) AS line, CAST(month(l_shipdate) AS DOUBLE) AS "month",
               CAST(day(l_shipdate) AS DOUBLE) AS "day", CAST(l_partkey % 1000 AS DOUBLE) AS part,
               CAST(l_orderkey % 100 AS DOUBLE) AS "order", """ + ", ".join(
        [f"CAST(l_suppkey % 4 = {i} AS INTEGER) AS Area_{i}" for i in range(4)]
        + [f"CAST(l_partkey % 40 = {i} AS INTEGER) AS Kind_{i}" for i in range(40)]) + """,
               CAST(1 + CASE
                   WHEN ('0x' || substr(md5('5:' || l_orderkey || ':' || l_linenumber), 1, 8))::BIGINT % 10 < 2
                   THEN ('0x' || substr(md5('6:' || l_orderkey || ':' || l_linenumber), 1, 8))::BIGINT % 7
                   ELSE (least(6, floor(l_quantity / 8)) + l_suppkey % 4
                         + CASE WHEN l_partkey % 40 >= 20 THEN 1 ELSE 0 END) % 7 END AS DOUBLE) AS y
        FROM lineitem""",
    "sessions": """
        SELECT l_orderkey, l_linenumber, l_quantity AS quantity, l_extendedprice AS price,
               l_discount AS discount, l_tax AS tax, l_returnflag AS returnflag,
               l_linestatus AS linestatus, o_orderpriority AS priority, o_orderstatus AS label
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
}


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs of the named analysis views."""
    if not names:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n]})" for n in names)
    return f"WITH {ctes}\n{body}"


def r6(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) + 0.0"


LINKAGE_NUMERIC = ["id_1", "id_2", "cmp_a", "cmp_b", "cmp_c", "cmp_d"]
LABELLED_COLS = (["q", "e", "d", "t", "u", "line", "month", "day", "part", "order"]
                 + [f"Area_{i}" for i in range(4)] + [f"Kind_{i}" for i in range(40)] + ["y"])
LINKAGE_COMPARE = ["cmp_a", "cmp_b", "cmp_c", "cmp_d"]


def _summary_rows(cols: list[str], src: str, where: str = "") -> list[str]:
    metric_fn = {"count": "count({})", "mean": "avg({})", "stddev": "stddev_samp({})",
                 "min": "min({})", "max": "max({})"}
    rows = []
    for m, fn in metric_fn.items():
        cells = ", ".join(f"{r6(fn.format(c))} AS {c}" for c in cols)
        rows.append(f"SELECT '{m}' AS summary, {cells} FROM {src} {where}")
    return rows


def _transposed_rows(cols: list[str], src: str, where: str = "") -> str:
    rows = []
    for c in cols:
        rows.append(
            f"SELECT '{c}' AS field, count({c})::DOUBLE AS count, avg({c}) AS mean, "
            f"stddev_samp({c}) AS stddev, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max "
            f"FROM {src} {where}")
    return " UNION ALL ".join(rows)


def _build() -> dict[str, str]:
    q: dict[str, str] = {}

    # ---- record linkage ---------------------------------------------------------
    q["label_counts"] = with_views(
        "SELECT is_match, count(*) AS count FROM linkage_like GROUP BY is_match",
        "linkage_like")
    q["label_counts_sql"] = with_views(
        "SELECT is_match, count(*) AS cnt FROM linkage_like GROUP BY is_match",
        "linkage_like")
    q["summary_stats"] = with_views(
        " UNION ALL ".join(_summary_rows(LINKAGE_NUMERIC, "linkage_like")), "linkage_like")
    t = _transposed_rows(LINKAGE_NUMERIC, "linkage_like")
    q["summary_transposed"] = with_views(
        f"SELECT field, {r6('count')} AS count, {r6('mean')} AS mean, "
        f"{r6('stddev')} AS stddev, {r6('min')} AS min, {r6('max')} AS max FROM ({t})",
        "linkage_like")
    grouped = " UNION ALL ".join(
        f"SELECT is_match, '{c}' AS field, {r6(f'count({c})')} AS count, {r6(f'avg({c})')} AS mean, "
        f"{r6(f'stddev_samp({c})')} AS stddev, {r6(f'min({c})')} AS min, {r6(f'max({c})')} AS max "
        "FROM linkage_like GROUP BY is_match" for c in LINKAGE_NUMERIC)
    q["grouped_summary"] = with_views(grouped, "linkage_like")
    a = _transposed_rows(LINKAGE_NUMERIC, "linkage_like", "WHERE is_match = true")
    b = _transposed_rows(LINKAGE_NUMERIC, "linkage_like", "WHERE is_match = false")
    q["feature_delta_ranking"] = with_views(
        f"SELECT a.field, {r6('a.count + b.count')} AS total, {r6('a.mean - b.mean')} AS delta "
        f"FROM ({a}) a JOIN ({b}) b ON a.field = b.field "
        f"WHERE a.field NOT IN ('id_1', 'id_2') ORDER BY delta DESC, total DESC",
        "linkage_like")
    q["feature_delta_ranking_sql"] = q["feature_delta_ranking"]
    q["pair_score"] = with_views(
        f"SELECT id_1, id_2, is_match, "
        f"{r6('coalesce(cmp_a,0) + coalesce(cmp_b,0) + coalesce(cmp_c,0) + coalesce(cmp_d,0)')}"
        f" AS score FROM linkage_like", "linkage_like")
    for name, thr in (("score_crosstab_t4", 4.0), ("score_crosstab_t2", 2.0)):
        q[name] = with_views(
            f"SELECT score >= {thr} AS above, "
            f"CAST(NULLIF(count_if(is_match = true), 0) AS BIGINT) AS \"true\", "
            f"CAST(NULLIF(count_if(is_match = false), 0) AS BIGINT) AS \"false\" "
            f"FROM (SELECT coalesce(cmp_a,0) + coalesce(cmp_b,0) + coalesce(cmp_c,0) "
            f"+ coalesce(cmp_d,0) AS score, is_match FROM linkage_like) GROUP BY 1",
            "linkage_like")
    q["item_plays_sql"] = with_views(
        'SELECT i.name, i.id, count(DISTINCT p."user") AS listeners, '
        'CAST(coalesce(sum(p."count"), 0) AS BIGINT) AS plays FROM items i LEFT JOIN plays p ON p.artist = i.id '
        "GROUP BY i.name, i.id", "plays", "items")
    q["table_structure"] = with_views(" UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS field, '{t}' AS type, count({c}) AS rows_with, "
        f"CAST(min({c}) AS VARCHAR) AS least, CAST(max({c}) AS VARCHAR) AS greatest "
        "FROM items LEFT JOIN alias_pairs ON id = artist"
        for i, (c, t) in enumerate((("id", "int"), ("name", "string"), ("artist", "int"), ("alias", "int")), 1)),
        "items", "alias_pairs")
    q["first_plays"] = with_views('SELECT * FROM plays ORDER BY "user", artist, "count" LIMIT 20', "plays")
    q["aliases_swapped"] = with_views("SELECT alias AS artist, artist AS alias FROM alias_pairs", "alias_pairs")
    for name, view, cols in (("distinct_counts", "linkage_like", LINKAGE_NUMERIC + ["is_match"]),
                             ("distinct_counts_labelled", "labelled", LABELLED_COLS)):
        q[name] = with_views(" UNION ALL ".join(
            f"SELECT '{c}' AS field, count(DISTINCT \"{c}\") + coalesce(max(CASE WHEN \"{c}\" IS NULL THEN 1 END), 0) "
            f"AS n_values FROM {view}" for c in cols), view)
    _sources(q)
    _recommend(q)
    _classify(q)
    _cluster(q)
    _text(q)
    return q


def md5_u32(*parts: str) -> str:
    given = ", ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts)
    return f"('0x' || substr(md5(concat_ws(':', {given})), 1, 8))::BIGINT"


def _sources(q: dict[str, str]) -> None:
    q["csv_roundtrip_infer"] = with_views("SELECT * FROM linkage_like", "linkage_like")
    q["csv_roundtrip_schema"] = q["csv_roundtrip_infer"]
    q["csv_positional"] = with_views(
        "SELECT * EXCLUDE (l_orderkey, l_linenumber) FROM labelled", "labelled")
    q["parse_strict"] = with_views('SELECT "user", artist, "count" FROM plays', "plays")
    q["parse_lenient"] = """
        SELECT CAST(p_partkey AS INTEGER) AS id,
               CASE p_partkey % 7 WHEN 2 THEN ''
                                  WHEN 5 THEN p_name || chr(9) || p_brand
                                  ELSE p_name END AS name
        FROM part WHERE p_partkey % 7 IN (2, 5, 6)"""
    q["parse_id_name_strict"] = with_views("SELECT id, name FROM items", "items")
    q["parse_alias_lenient"] = with_views("SELECT artist, alias FROM alias_pairs", "alias_pairs")
    q["xml_pages"] = "SELECT 'doc ' || doc_id AS title, text FROM documents"
    q["xml_dump_text"] = ("SELECT 'doc ' || doc_id AS title, text AS content FROM documents "
                          "WHERE length(text) > 0")


def _split_sql() -> str:
    return (f"SELECT *, ({md5_u32('0', '\"user\"', 'artist')} % 10) < 9 AS is_train "
            f"FROM plays")


def _recommend(q: dict[str, str]) -> None:
    q["id_ranges"] = with_views(
        'SELECT min("user") AS min_user, max("user") AS max_user, '
        'min(artist) AS min_artist, max(artist) AS max_artist FROM plays', "plays")
    q["alias_resolve"] = with_views(
        'SELECT p."user", coalesce(a.alias, p.artist) AS artist, p."count" '
        'FROM plays p LEFT JOIN alias_pairs a ON p.artist = a.artist', "plays", "alias_pairs")
    q["item_lookup"] = with_views("SELECT id, name FROM items WHERE id IN (10, 20)", "items")
    q["user_history"] = with_views(
        'SELECT id, name FROM items WHERE id IN (SELECT artist FROM plays WHERE "user" = 7)',
        "plays", "items")
    split = _split_sql()
    q["hash_split"] = with_views(
        f"SELECT \"user\", artist, \"count\", CASE WHEN is_train THEN 'train' ELSE 'test' END "
        f"AS split FROM ({split})", "plays")
    q["popularity_predict"] = with_views(
        f"SELECT p.\"user\", p.artist, l.prediction FROM plays p LEFT JOIN "
        f"(SELECT artist, CAST(sum(\"count\") AS BIGINT) AS prediction FROM ({split}) "
        f"WHERE is_train GROUP BY artist) l ON p.artist = l.artist", "plays")
    resolved = with_views(
        'SELECT p."user", coalesce(a.alias, p.artist) AS artist FROM plays p '
        'LEFT JOIN alias_pairs a ON p.artist = a.artist', "plays", "alias_pairs")
    q["als_factors_check"] = (
        f"SELECT 'user' AS side, \"user\" AS id, CAST(10 AS INTEGER) AS width FROM ({resolved}) GROUP BY ALL "
        f"UNION ALL SELECT 'item', artist, CAST(10 AS INTEGER) FROM ({resolved}) GROUP BY ALL")
    q["als_topn_check"] = (
        f'SELECT "user", CAST(5 AS BIGINT) AS n, true AS known, true AS ranked, true AS falling FROM ({resolved}) '
        f"WHERE ({md5_u32('0', '\"user\"', 'artist')} % 10) >= 9 "
        f'AND "user" IN (SELECT "user" FROM ({resolved}) WHERE ({md5_u32("0", chr(34) + "user" + chr(34), "artist")} '
        '% 10) < 9) GROUP BY "user" ORDER BY "user" LIMIT 100')
    q["als_topn_user_check"] = "SELECT CAST(5 AS BIGINT) AS shared, true AS same FROM lineitem LIMIT 1"
    q["als_grid_check"] = """
        SELECT CAST(rank AS INTEGER) AS rank, CAST(reg AS DOUBLE) AS reg, CAST(alpha AS DOUBLE) AS alpha,
               true AS usable
        FROM (VALUES (5), (30)) a(rank), (VALUES (4.0), (0.0001)) b(reg), (VALUES (1.0), (40.0)) c(alpha)
        WHERE (SELECT count(*) FROM lineitem) > 0"""
    q["distinct_items"] = with_views("SELECT DISTINCT artist FROM plays", "plays")
    q["first_n_users"] = with_views(
        'SELECT DISTINCT "user" FROM plays ORDER BY "user" LIMIT 100', "plays")
    negatives = f"""
        split AS ({split}),
        cv AS (SELECT * FROM split WHERE NOT is_train),
        cat AS (SELECT artist, row_number() OVER (ORDER BY artist) - 1 AS idx
                FROM (SELECT DISTINCT artist FROM plays)),
        n AS (SELECT count(*) AS n FROM cat),
        pos AS (SELECT DISTINCT "user", artist FROM cv),
        targets AS (SELECT "user", count(*) AS target FROM pos GROUP BY "user"),
        slots AS (SELECT "user", target, slot,
                         {md5_u32('7', '"user"', 'slot')} % n AS idx
                  FROM (SELECT t."user", t.target, n.n, unnest(range(1, n.n + 1)) AS slot
                        FROM targets t CROSS JOIN n)),
        draws AS (SELECT s."user", s.target, s.slot, c.artist FROM slots s JOIN cat c
                  ON c.idx = s.idx),
        hits AS (SELECT d.* FROM draws d ANTI JOIN pos p
                 ON d."user" = p."user" AND d.artist = p.artist),
        neg AS (SELECT "user", artist FROM (
                  SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY slot) AS k
                  FROM hits) WHERE k <= target)"""
    q["negative_sample"] = with_views(
        f"WITH {negatives.strip()} SELECT \"user\", artist FROM neg", "plays"
    ).replace(")\nWITH ", "),\n", 1)
    auc = f"""
        {negatives.strip()},
        pop AS (SELECT artist, sum("count") AS prediction FROM split WHERE is_train
                GROUP BY artist),
        pp AS (SELECT cv."user", pop.prediction AS p FROM cv LEFT JOIN pop USING (artist)),
        np AS (SELECT neg."user", pop.prediction AS q FROM neg LEFT JOIN pop USING (artist)),
        per_user AS (SELECT pp."user", count_if(pp.p > np.q) / count(*) AS auc
                     FROM pp JOIN np ON pp."user" = np."user" GROUP BY pp."user")"""
    q["auc_exhaustive"] = with_views(f"""WITH split AS ({split}),
        cv AS (SELECT * FROM split WHERE NOT is_train),
        pop AS (SELECT artist, sum("count") AS prediction FROM split WHERE is_train
                GROUP BY artist),
        cat AS (SELECT c.artist, pop.prediction AS q
                FROM (SELECT DISTINCT artist FROM plays) c LEFT JOIN pop USING (artist)),
        own AS (SELECT DISTINCT "user", artist FROM cv),
        neg AS (SELECT u."user", cat.q FROM (SELECT DISTINCT "user" FROM cv) u CROSS JOIN cat
                WHERE NOT EXISTS (SELECT 1 FROM own o WHERE o."user" = u."user"
                                  AND o.artist = cat.artist)),
        pp AS (SELECT cv."user", pop.prediction AS p FROM cv LEFT JOIN pop USING (artist)),
        per_user AS (SELECT pp."user", count_if(pp.p > neg.q) / count(*) AS auc
                     FROM pp JOIN neg ON pp."user" = neg."user" GROUP BY pp."user")
        SELECT "user", {r6('auc')} AS auc FROM per_user""", "plays").replace(
        ")\nWITH ", "),\n", 1)
    def factors(name: str, column: str, salt: int, without: int) -> str:
        return f"""{name} AS (
            SELECT id, list_transform(range(0, 8), lambda f: CAST(
                ((id * (2 * f + 3) * 31 + f * f * 17 + {salt}) % 257 - 128) * (1 + id % 7) AS DOUBLE) / 1024) AS f
            FROM (SELECT DISTINCT CAST("{column}" AS BIGINT) AS id FROM plays) WHERE id % {without} <> 3)"""
    both = factors("uf", "user", 1, 40) + ", " + factors("vf", "artist", 2, 50)
    q["auc_all_items"] = with_views(f"""WITH split AS ({split}),
        cv AS (SELECT * FROM split WHERE NOT is_train), {both},
        scores AS (SELECT u."user", c.artist, list_dot_product(uf.f, vf.f) AS s
                   FROM (SELECT DISTINCT "user" FROM cv) u CROSS JOIN (SELECT DISTINCT artist FROM plays) c
                   LEFT JOIN uf ON uf.id = u."user" LEFT JOIN vf ON vf.id = c.artist),
        neg AS (SELECT s."user", s.s AS q FROM scores s ANTI JOIN cv
                ON cv."user" = s."user" AND cv.artist = s.artist),
        pp AS (SELECT cv."user", s.s AS p FROM cv JOIN scores s USING ("user", artist)),
        per_user AS (SELECT pp."user", count(*) FILTER (WHERE pp.p > neg.q) / count(*) AS auc
                     FROM pp JOIN neg ON pp."user" = neg."user" GROUP BY pp."user")
        SELECT "user", {r6('auc')} AS auc FROM per_user""", "plays").replace(")\nWITH ", "),\n", 1)
    for name, n, seen in (("top_items_all", 5, ""), ("top_items_unseen", 20,
                          'ANTI JOIN plays ON plays."user" = uf.id AND plays.artist = vf.id')):
        q[name] = with_views(f"""WITH {both},
            ranked AS (
                SELECT uf.id AS "user", vf.id AS artist, list_dot_product(uf.f, vf.f) AS s,
                       row_number() OVER (PARTITION BY uf.id
                                          ORDER BY list_dot_product(uf.f, vf.f) DESC, vf.id) AS rank
                FROM uf CROSS JOIN vf {seen})
            SELECT CAST("user" AS INTEGER) AS "user", CAST(rank AS INTEGER) AS rank,
                   CAST(artist AS INTEGER) AS artist, {r6('s')} AS prediction
            FROM ranked WHERE rank <= {n}""", "plays").replace(")\nWITH ", "),\n", 1)
    q["als_topn_unseen_check"] = (
        f'WITH train AS (SELECT * FROM ({resolved}) WHERE ({md5_u32("0", chr(34) + "user" + chr(34), "artist")} '
        '% 10) < 9) SELECT "user", least(5, (SELECT count(DISTINCT artist) FROM train) - count(DISTINCT artist)) '
        'AS n, true AS unseen, true AS falling, true AS ranked FROM train GROUP BY "user"')
    q["auc_sampled"] = with_views(
        f"WITH {auc.strip()} SELECT \"user\", {r6('auc')} AS auc FROM per_user", "plays"
    ).replace(")\nWITH ", "),\n", 1)
    q["auc_mean"] = with_views(
        f"WITH {auc.strip()} SELECT {r6('avg(auc)')} AS mean_auc, count(*) AS users "
        f"FROM per_user", "plays").replace(")\nWITH ", "),\n", 1)


def _classify(q: dict[str, str]) -> None:
    split = (f"SELECT *, ({md5_u32('0', 'l_orderkey', 'l_linenumber')} % 10) < 9 AS is_train "
             f"FROM labelled")
    q["class_priors"] = with_views(
        f"SELECT y, count(*) AS count, {r6('count(*) / (SELECT count(*) FROM sp WHERE is_train)')}"
        f" AS p FROM sp WHERE is_train GROUP BY y", "labelled").replace(
        "\nSELECT", f",\nsp AS ({split})\nSELECT", 1)
    q["prior_accuracy"] = with_views(
        "SELECT " + r6("sum(a.p * b.p)") + " AS accuracy FROM "
        "(SELECT y, count(*) / (SELECT count(*) FROM sp WHERE is_train) AS p FROM sp "
        " WHERE is_train GROUP BY y) a JOIN "
        "(SELECT y, count(*) / (SELECT count(*) FROM sp WHERE NOT is_train) AS p FROM sp "
        " WHERE NOT is_train GROUP BY y) b ON a.y = b.y", "labelled").replace(
        "\nSELECT", f",\nsp AS ({split})\nSELECT", 1)
    rule = ("SELECT y, CAST(1 + least(6, floor((q + 3 * (l_linenumber % 3) - 3) / 8)) AS DOUBLE)"
            " AS prediction FROM labelled")
    cells = ", ".join(f'CAST(count_if(prediction = {c}) AS BIGINT) AS "{c}"' for c in range(1, 8))
    q["confusion_matrix"] = with_views(
        f"SELECT y, {cells} FROM ({rule}) GROUP BY y ORDER BY y", "labelled")
    q["accuracy_f1"] = with_views(f"""
        SELECT {r6('sum(tp) / sum(actual)')} AS accuracy,
               {r6('sum(CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0 END'
                   ' * actual) / sum(actual)')} AS weighted_f1
        FROM (SELECT a.actual, coalesce(t.tp, 0) AS tp,
                     CASE WHEN coalesce(pr.predicted, 0) > 0 THEN coalesce(t.tp, 0) / pr.predicted
                          ELSE 0 END AS prec,
                     coalesce(t.tp, 0) / a.actual AS rec
              FROM (SELECT y AS c, count(*) AS actual FROM ({rule}) GROUP BY y) a
              LEFT JOIN (SELECT y AS c, count(*) AS tp FROM ({rule}) WHERE y = prediction
                         GROUP BY y) t ON a.c = t.c
              LEFT JOIN (SELECT prediction AS c, count(*) AS predicted FROM ({rule})
                         GROUP BY prediction) pr ON a.c = pr.c)""", "labelled")
    area, kind = (", ".join(f"{g}_{i}" for i in range(n)) for g, n in (("Area", 4), ("Kind", 40)))
    q["undo_one_hot"] = with_views(
        'SELECT q, e, d, t, u, line, "month", "day", part, "order", y, '
        f"CAST(coalesce(list_position([{area}], 1), 0) - 1 AS DOUBLE) AS area, "
        f"CAST(coalesce(list_position([{kind}], 1), 0) - 1 AS DOUBLE) AS kind FROM labelled", "labelled")
    numeric = ["q", "e", "d", "t", "u", "line", "month", "day", "part", "order"]

    def sampled(body: str) -> str:
        return with_views(body, "labelled").replace("\nSELECT", f",\nsp AS ({split})\nSELECT", 1)

    q["tree_predict_check"] = sampled(
        "SELECT l_orderkey, l_linenumber, true AS is_class, true AS has_all, true AS adds_up, "
        "true AS is_likeliest FROM sp WHERE NOT is_train")
    q["tree_confusion_check"] = sampled(
        'SELECT y, count(*) AS rows, true AS "between" FROM sp WHERE NOT is_train GROUP BY y')
    q["tree_grid_check"] = """
        SELECT impurity, CAST(depth AS INTEGER) AS maxDepth, CAST(bins AS INTEGER) AS maxBins,
               CAST(gain AS DOUBLE) AS minInfoGain, true AS usable, true AS best_is_best,
               true AS learnt
        FROM (VALUES ('gini'), ('entropy')) a(impurity), (VALUES (1), (20)) b(depth),
             (VALUES (40), (300)) c(bins), (VALUES (0.0), (0.05)) g(gain)
        WHERE (SELECT count(*) FROM lineitem) > 0"""
    q["tree_text_check"] = ("SELECT true AS leaves, true AS questions, true AS levels, true AS known "
                            "WHERE (SELECT count(*) FROM lineitem) > 0")
    q["tree_categorical_check"] = sampled(
        "SELECT count(*) AS rows, true AS is_class, true AS learnt FROM sp WHERE NOT is_train")
    q["ranking_check"] = """
        SELECT 'tree' AS model, CAST(54 AS INTEGER) AS features, true AS falling
        UNION ALL SELECT 'forest', CAST(12 AS INTEGER), true"""
    q["kmeans_sample_check"] = "SELECT true AS about, true AS known WHERE (SELECT count(*) FROM lineitem) > 0"
    wide = [*numeric, *area.split(", "), *kind.split(", ")]
    q["importance_check"] = " UNION ALL ".join(
        f"SELECT '{m}' AS model, '{f}' AS feature, true AS adds_up"
        for m, fs in (("tree", wide), ("forest", [*numeric, "area", "kind"])) for f in fs)


def _sqdist(a: str, b: str) -> str:
    return (f"list_reduce(list_transform(list_zip({a}, {b}), "
            f"lambda x: (x[1] - x[2]) * (x[1] - x[2])), lambda s, v: s + v)")


def _dot(a: str, b: str) -> str:
    return (f"list_reduce(list_transform(list_zip({a}, {b}), lambda x: x[1] * x[2]), "
            f"lambda s, v: s + v)")


def _cluster(q: dict[str, str]) -> None:
    fixed = f"""WITH centers AS (
            SELECT row_number() OVER (ORDER BY label) - 1 AS cluster,
                   arg_min(embedding, vec_id)::DOUBLE[] AS c
            FROM embeddings GROUP BY label),
        dists AS (
            SELECT e.vec_id, e.label, c.cluster, {_sqdist('e.embedding::DOUBLE[]', 'c.c')} AS dist
            FROM embeddings e CROSS JOIN centers c),
        best AS (
            SELECT vec_id, label, arg_min(cluster, dist) AS cluster, min(dist) AS dist
            FROM dists GROUP BY vec_id, label)
        """
    q["nearest_center"] = fixed + f"SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, {r6('dist')} AS dist FROM best"
    q["mean_cost"] = fixed + f"SELECT {r6('sum(dist)')} AS cost, {r6('avg(dist)')} AS mean_cost FROM best"
    q["label_by_cluster"] = fixed + ("SELECT CAST(cluster AS INTEGER) AS cluster, label, count(*) AS count "
                                     "FROM best GROUP BY ALL ORDER BY cluster, label")
    q["cluster_sizes"] = fixed + ("SELECT CAST(cluster AS INTEGER) AS cluster, count(*) AS count "
                                  "FROM best GROUP BY ALL")
    q["cluster_id_max"] = fixed + "SELECT CAST(max(cluster) AS INTEGER) AS max_cluster FROM best"
    rows = "CAST((SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey) AS BIGINT) AS rows"
    q["kmeans_cost_check"] = (f"SELECT model, {rows}, true AS at_most_k, true AS same_cost FROM "
                              "(VALUES ('plain'), ('scaled'), ('centred'), ('one_hot')) v(model)")
    q["kmeans_sweep_check"] = """
        SELECT sweep, CAST(k AS INTEGER) AS k, true AS ok FROM (
            SELECT sweep, unnest(range(20, 101, 20)) AS k FROM (VALUES ('plain'), ('tight')) v(sweep)
            UNION ALL SELECT 'entropy', unnest(range(60, 271, 30)))"""
    q["anomalies_fitted_check"] = ("SELECT count(*) >= 100 AS enough, true AS known "
                                   "FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
    q["kmeans_formula_check"] = f"SELECT {rows}, true AS in_range, true AS close"
    q["pca_check"] = ("SELECT CAST(component AS INTEGER) AS component, CAST((SELECT count(*) FROM embeddings) "
                      "AS BIGINT) AS rows, true AS centred, true AS as_said "
                      "FROM (SELECT unnest(range(1, 4)) AS component)")
    q["cluster_entropy"] = fixed + f"""
        , counts AS (SELECT cluster, label, count(*) AS n FROM best GROUP BY ALL),
          sizes AS (SELECT cluster, sum(n) AS n_c FROM counts GROUP BY cluster)
        SELECT {r6('sum(-n * ln(n / n_c)) / sum(n)')} AS entropy, CAST(sum(n) AS BIGINT) AS rows
        FROM counts JOIN sizes USING (cluster)"""
    q["anomalies_topk"] = fixed + """
        SELECT vec_id, label FROM best
        WHERE dist >= (SELECT min(dist) FROM (SELECT dist FROM best ORDER BY dist DESC LIMIT 100))"""
    long = """WITH long AS (
            SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS dim,
                   CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
        st AS (SELECT dim, avg(x) AS m, stddev_samp(x) AS sd FROM long GROUP BY dim)
        """
    q["standardize"] = long + (
        f"SELECT vec_id, CAST(dim AS INTEGER) AS dim, "
        f"{r6('CASE WHEN sd = 0 THEN 0.0 ELSE x / sd END')} AS value FROM long JOIN st USING (dim)")
    q["standardize_centered"] = long + (
        f"SELECT vec_id, CAST(dim AS INTEGER) AS dim, "
        f"{r6('CASE WHEN sd = 0 THEN 0.0 ELSE (x - m) / sd END')} AS value "
        f"FROM long JOIN st USING (dim)")
    q["session_label_counts"] = with_views(
        "SELECT label, count(*) AS count FROM sessions GROUP BY label", "sessions")
    q["one_hot"] = with_views("""
        SELECT l_orderkey, l_linenumber, priority, CAST(idx AS INTEGER) AS priority_index,
               CAST(CASE WHEN idx < n_levels - 1 THEN idx ELSE -1 END AS INTEGER) AS hot
        FROM sessions JOIN (
            SELECT priority, row_number() OVER (ORDER BY count(*) DESC, priority) - 1 AS idx,
                   count(*) OVER () AS n_levels
            FROM sessions GROUP BY priority) USING (priority)""", "sessions")
    cells = []
    for c in LINKAGE_NUMERIC:
        cells.append(
            f"SELECT '{c}' AS field, CAST(CASE WHEN count({c}) = 0 THEN 1 "
            f"WHEN count({c}) = count(*) AND min({c}) = max({c}) THEN 1 ELSE 2 END AS INTEGER) "
            f"AS n_values FROM linkage_like")
    cells.append("SELECT 'is_match' AS field, CAST(CASE WHEN count(is_match) = 0 THEN 1 "
                 "WHEN count(is_match) = count(*) AND min(is_match) = max(is_match) THEN 1 "
                 "ELSE 2 END AS INTEGER) AS n_values FROM linkage_like")
    q["constant_columns"] = with_views(
        f"SELECT field, n_values, n_values <= 1 AS constant FROM ({' UNION ALL '.join(cells)})",
        "linkage_like")
    from workbench.operators.project import projection_matrix
    m = projection_matrix(64, 3, seed=42)
    cols = []
    for j in range(3):
        lit = "[" + ", ".join(repr(float(v)) for v in m[:, j]) + "]::DOUBLE[]"
        cols.append(f"{r6(_dot('embedding::DOUBLE[]', lit))} AS x{j + 1}")
    q["random_projection"] = f"SELECT vec_id, {', '.join(cols)} FROM embeddings"


def _text(q: dict[str, str]) -> None:
    from workbench.operators.text import LEMMAS, STOP_WORDS
    stop = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"
    lemma_map = "MAP {" + ", ".join(f"'{a}': '{b}'" for a, b in LEMMAS) + "}"

    def terms(lemma: bool) -> str:
        words = ("list_transform(list_filter(regexp_split_to_array(text, '[^\\p{L}]+'), "
                 "lambda w: length(w) > 0), lambda w: lower(w))")
        if lemma:
            words = (f"list_transform({words}, lambda w: coalesce("
                     f"map_extract_value({lemma_map}, w), w))")
        return (f"SELECT doc_id, list_filter({words}, lambda w: length(w) >= 3 AND NOT "
                f"list_contains({stop}, w)) AS terms FROM documents")

    docs = f"WITH docs AS (SELECT * FROM ({terms(False)}) WHERE len(terms) >= 2)\n"
    q["doc_terms"] = docs + ("SELECT doc_id, CAST(len(terms) AS INTEGER) AS n_terms, "
                             "CAST(len(list_distinct(terms)) AS INTEGER) AS n_distinct FROM docs")
    tf = docs + (", tf AS (SELECT doc_id, term, count(*) AS tf FROM "
                 "(SELECT doc_id, unnest(terms) AS term FROM docs) GROUP BY ALL)\n")
    q["term_freq"] = tf + "SELECT doc_id, term, tf FROM tf"
    vocab = tf + (", vocab AS (SELECT row_number() OVER (ORDER BY count DESC, term) - 1 AS term_id, "
                  "term, count FROM (SELECT term, CAST(sum(tf) AS BIGINT) AS count FROM tf "
                  "GROUP BY term ORDER BY count DESC, term LIMIT 20000))\n")
    q["vocabulary"] = vocab.replace("\n, ", ",\n") + "SELECT CAST(term_id AS INTEGER) AS term_id, term, count FROM vocab"
    idf = vocab + (", idf AS (SELECT v.term_id, v.term, d.df, "
                   "ln(((SELECT count(DISTINCT doc_id) FROM tf) + 1) / (d.df + 1)) AS idf "
                   "FROM vocab v JOIN (SELECT term, count(*) AS df FROM tf GROUP BY term) d "
                   "USING (term))\n")
    q["idf"] = idf.replace("\n, ", ",\n") + f"SELECT CAST(term_id AS INTEGER) AS term_id, term, df, {r6('idf')} AS idf FROM idf"
    q["tfidf"] = idf.replace("\n, ", ",\n") + (
        f"SELECT tf.doc_id, CAST(idf.term_id AS INTEGER) AS term_id, tf.term, tf.tf, "
        f"{r6('tf.tf * idf.idf')} AS tfidf FROM tf JOIN idf USING (term)")
    short = "substr(w, 1, length(w) - 1)"
    in_train = f"{md5_u32('3', 'lemma')} % 10 < 7"
    q["lemma_rules"] = f"""
        WITH words AS (
            SELECT DISTINCT lower(w) AS w
            FROM (SELECT unnest(regexp_split_to_array(text, '[^\\p{{L}}]+')) AS w FROM documents)
            WHERE length(w) >= 4),
        pairs AS (
            SELECT CASE WHEN regexp_matches(w, '(s|x|z|sh|ch)$') THEN w || 'es' WHEN w LIKE '%y' THEN {short} || 'ies'
                        ELSE w || 's' END AS form, w AS lemma FROM words
            UNION SELECT CASE WHEN w LIKE '%e' THEN w || 'd' WHEN w LIKE '%y' THEN {short} || 'ied'
                              ELSE w || 'ed' END, w FROM words
            UNION SELECT CASE WHEN w LIKE '%e' THEN {short} ELSE w END || 'ing', w FROM words),
        shared AS (
            SELECT form, lemma, len(list_filter(range(1, least(length(form), length(lemma)) + 1),
                                                lambda i: substr(form, 1, i) = substr(lemma, 1, i))) AS n
            FROM pairs WHERE {in_train}),
        votes AS (
            SELECT size, substr(form, length(form) - size + 1) AS suffix, length(form) - n AS cut,
                   substr(lemma, n + 1) AS added
            FROM shared, range(0, 7) s(size) WHERE size <= length(form) AND size >= length(form) - n),
        rules AS (
            SELECT size, suffix, cut, added FROM (
                SELECT size, suffix, cut, added, row_number() OVER (PARTITION BY suffix ORDER BY n DESC, cut, added) AS k
                FROM (SELECT size, suffix, cut, added, count(*) AS n FROM votes GROUP BY size, suffix, cut, added)
                WHERE n >= 2) WHERE k = 1),
        ends AS (
            SELECT form, size, right(form, size) AS suffix FROM (SELECT DISTINCT form FROM pairs), range(0, 7) s(size)
            WHERE size <= length(form)),
        found AS (
            SELECT e.form, arg_max(substr(e.form, 1, length(e.form) - r.cut) || r.added, e.size) AS lemma
            FROM ends e JOIN rules r ON r.suffix = e.suffix AND r.size = e.size GROUP BY e.form),
        guesses AS (SELECT form, coalesce(f.lemma, form) AS guess FROM (SELECT DISTINCT form FROM pairs)
                    LEFT JOIN found f USING (form)),
        exceptions AS (
            SELECT t.form, t.lemma FROM (SELECT form, max(lemma) AS lemma FROM pairs WHERE {in_train} GROUP BY form) t
            JOIN guesses g USING (form) WHERE g.guess <> t.lemma)
        SELECT form, p.lemma, coalesce(x.lemma, g.guess) AS guess, p.lemma = coalesce(x.lemma, g.guess) AS "right"
        FROM pairs p JOIN guesses g USING (form) LEFT JOIN exceptions x USING (form)
        WHERE NOT ({in_train.replace("lemma", "p.lemma")})"""
    q["markup_text"] = (
        "SELECT doc_id, trim(regexp_replace(text, '[^\\p{L}]+', ' ', 'g')) AS content FROM documents "
        "WHERE length(trim(regexp_replace(text, '[^\\p{L}]+', ' ', 'g'))) > 0")
    q["svd_check"] = idf.replace("\n, ", ",\n") + (
        "SELECT CAST(component AS INTEGER) AS component, CAST(1 AS DOUBLE) AS left_length, "
        "CAST(1 AS DOUBLE) AS right_length, CAST(1 AS DOUBLE) AS again, true AS settled, "
        "(SELECT round(sum((tf.tf * idf.idf) ** 2), 2) FROM tf JOIN idf USING (term)) AS total "
        "FROM range(1, 11) c(component)")
    folded = ("list_filter(list_transform(regexp_extract_all(lower(text), '\\p{L}+'), "
              "lambda w: strip_accents(w)), lambda w: length(w) >= 3)")
    q["doc_terms_pandas"] = (
        "SELECT doc_id, CAST(len(terms) AS INTEGER) AS n_terms, CAST(len(list_distinct(terms)) AS INTEGER) "
        f"AS n_distinct FROM (SELECT doc_id, {folded} AS terms FROM documents) WHERE len(terms) >= 2")
    tokens = ("list_transform(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+'), lambda w: "
              "lower(regexp_replace(w, '^[^\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+$', '', 'g')))")
    q["doc_terms_letters"] = (
        "SELECT doc_id, CAST(len(terms) AS INTEGER) AS n_terms, CAST(len(list_distinct(terms)) AS INTEGER) "
        f"AS n_distinct FROM (SELECT doc_id, list_filter({tokens}, lambda w: length(w) >= 3 AND "
        f"regexp_full_match(w, '\\p{{L}}+') AND NOT list_contains({stop}, w)) AS terms FROM documents) "
        "WHERE len(terms) >= 2")
    q["tfidf_vectors"] = idf.replace("\n, ", ",\n") + (
        f", w AS (SELECT tf.doc_id, tf.tf * idf.idf AS tfidf FROM tf JOIN idf USING (term))\n"
        f"SELECT d.doc_id, CAST(coalesce(count_if(w.tfidf <> 0), 0) AS INTEGER) AS nnz, "
        f"{r6('coalesce(sum(w.tfidf), 0)')} AS weight "
        f"FROM docs d LEFT JOIN w USING (doc_id) GROUP BY d.doc_id").replace("\n, w AS", ",\nw AS")
    q["term_freq"] = q["term_freq"].replace("\n, ", ",\n")
    ldocs = f"WITH docs AS (SELECT * FROM ({terms(True)}) WHERE len(terms) >= 2)\n"
    q["lemma_terms"] = ldocs + ("SELECT term, count(*) AS total FROM "
                                "(SELECT unnest(terms) AS term FROM docs) GROUP BY term")
    ent = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "''"), ("&#39;", "''"), ("&nbsp;", " "),
           ("&amp;", "&")]

    def unesc(x: str) -> str:
        for a, b in ent:
            x = f"replace({x}, '{a}', '{b}')"
        return x
    title = unesc("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")
    body = "html"
    for pat in [r"(?is)<head(?:\s[^>]*)?>.*?</head>", r"(?is)<script[^>]*>.*?</script>",
                r"(?is)<style[^>]*>.*?</style>", r"(?s)<!--.*?-->", r"<[^>]*>"]:
        body = f"regexp_replace({body}, '{pat}', ' ', 'g')"
    content = f"trim(regexp_replace({unesc(body)}, '[ \\t\\n\\r\\f]+', ' ', 'g'))"
    q["page_text"] = (f"SELECT page_id, trim(regexp_replace({title}, '[ \\t\\n\\r\\f]+', ' ', 'g')) "
                      f"AS title, content FROM (SELECT page_id, html, {content} AS content FROM pages) "
                      f"WHERE length(content) > 0")


ORACLE = _build()
