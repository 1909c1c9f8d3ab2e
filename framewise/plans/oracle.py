"""SQL oracle: for each registered query, an equivalent DuckDB SQL string over
the raw tables.  Written independently of the Spark plans (different join
orders, windows instead of distributed numbering, recursion instead of a
frontier loop) so that agreement means something.  Floating columns are
rounded to the same 6 decimals as the Spark side.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable

from framewise.operators.verbs import draw_below
from framewise.plans import catalog as C
from framewise.functions import stemming as sm
from framewise.sources.lexicons import english_stop_words
from framewise.sources.views import GRID_WIDTH, WALL_SIZE

D = C.DECIMALS
TOKEN = "[\\p{L}\\p{N}]+"


def rnd(sql: str, *cols: str) -> str:
    if not cols:
        return sql
    rep = ", ".join(f"round({c}, {D}) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) AS q"


def with_(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def stop_values() -> str:
    rows = ", ".join(f"({_q(w)})" for w in english_stop_words())
    return f"sw AS (SELECT * FROM (VALUES {rows}) AS t(word))"


def stop_list() -> str:
    return "[" + ", ".join(_q(w) for w in english_stop_words()) + "]"


def polarity_ctes() -> str:
    """pol(axis, word, sentiment, weight) and lex(word, sentiment); needs words and sw."""
    return (
        "lw AS (SELECT w.word, l.quality, 1 - l.toxic AS toxic FROM words w JOIN labels l ON l.doc_id = w.page "
        "WHERE w.word NOT IN (SELECT word FROM sw)), "
        "cl AS (SELECT axis, word, CAST(sum(y) AS DOUBLE) AS p, CAST(sum(1 - y) AS DOUBLE) AS q FROM "
        "(SELECT 'quality' AS axis, word, quality AS y FROM lw UNION ALL SELECT 'toxic', word, toxic FROM lw) "
        "WHERE y IN (0, 1) GROUP BY axis, word), "
        "tot AS (SELECT axis, sum(p) AS tp, sum(q) AS tq FROM cl GROUP BY axis), "
        "pr AS (SELECT *, 500.0::DOUBLE * (p + q) / (tp + tq) AS a FROM cl JOIN tot USING (axis)), "
        "lo AS (SELECT axis, word, p + q AS n, ln((p + a) / nullif(tp + 500.0::DOUBLE - p - a, 0)) - "
        "ln((q + a) / nullif(tq + 500.0::DOUBLE - q - a, 0)) AS weight, "
        "sqrt(1 / (p + a) + 1 / (q + a)) AS e FROM pr), "
        "pol AS (SELECT axis, word, CASE WHEN weight > 0 THEN 'positive' ELSE 'negative' END AS sentiment, weight "
        "FROM lo WHERE n >= 10 AND abs(weight) >= 1.96 * e), "
        "lex AS (SELECT DISTINCT word, sentiment FROM pol)")


def _suffix_step(rules, otherwise: str = "stem") -> str:
    return "CASE " + " ".join(f"WHEN ends_with(stem, {_q(s)}) THEN {r}" for s, r in rules) + f" ELSE {otherwise} END"


APOSTROPHES = ("^'", "('s'|'s|')$")


def stem_ctes(words: str) -> str:
    """stems(word, stem) of the column word of the CTE ``words``."""
    cut = lambda n: f"left(stem, length(stem) - {n})"
    behind = lambda s, p: f"length(stem) - {len(s)} >= {p}"

    def swap(s, to, test):
        return s, f"CASE WHEN {test} AND NOT done THEN {cut(len(s))} || {_q(to)} ELSE stem END"

    def is_like(pattern, c="stem"):
        return f"regexp_matches({c}, {_q(pattern)})"

    v = sm.VOWEL
    region = f"^.*?{v}{sm.CONSONANT}"
    plural = [("sses", cut(2)), *[(s, f"{cut(3)} || CASE WHEN length(stem) > 4 THEN 'i' ELSE 'ie' END")
                                  for s in ("ied", "ies")],
              ("us", "stem"), ("ss", "stem"), ("s", f"CASE WHEN {is_like(v + '.+s$')} THEN {cut(1)} ELSE stem END")]
    verbs = [(s, "NULL" if s.startswith("eed") else f"CASE WHEN {is_like(v, cut(len(s)))} THEN {cut(len(s))} END")
             for s in ("ingly", "eedly", "edly", "eed", "ing", "ed")]
    mended = (f"CASE WHEN {is_like('(at|bl|iz)$', 'c')} THEN c || 'e' WHEN {is_like('(' + '|'.join(sm.DOUBLES) + ')$', 'c')} "
              f"THEN left(c, length(c) - 1) WHEN length(c) <= p1 AND {is_like(sm.SHORT_SYLLABLE, 'c')} THEN c || 'e' "
              "ELSE c END")
    derived = [swap(s, to, behind(s, "p1") + {"ogi": f" AND {is_like('[' + sm.BEFORE_OGI + ']ogi$')}",
                                              "li": f" AND {is_like('[' + sm.BEFORE_LI + ']li$')}"}.get(s, ""))
               for s, to in sm.DERIVATIONS]
    adjectives = [swap(s, to, behind(s, "p2" if s == "ative" else "p1")) for s, to in sm.ADJECTIVES]
    endings = [swap(s, "", behind(s, "p2") + (f" AND {is_like('[' + sm.BEFORE_ION + ']ion$')}" if s == "ion" else ""))
               for s in sm.ENDINGS]
    last = [swap("e", "", f"({behind('e', 'p2')} OR ({behind('e', 'p1')} AND NOT {is_like(sm.SHORT_SYLLABLE, cut(1))}))"),
            swap("l", "", f"{behind('l', 'p2')} AND ends_with(stem, 'll')")]
    special = " ".join(f"WHEN word = {_q(w)} THEN {_q(to)}" for w, to in sm.SPECIAL.items())
    stays = ", ".join(map(_q, sm.STAY_AFTER_PLURALS))
    return ", ".join((
        f"st0 AS (SELECT DISTINCT word, regexp_replace(regexp_replace(regexp_replace(regexp_replace(word, {_q(APOSTROPHES[0])}, "
        f"''), {_q(APOSTROPHES[1])}, ''), '^y', 'Y'), '({v})y', '\\1Y', 'g') AS stem FROM {words} "
        "WHERE word IS NOT NULL)",
        "st1 AS (SELECT *, CASE WHEN f = '' THEN length(stem) ELSE length(f) END AS p1 FROM (SELECT *, "
        f"regexp_extract(stem, {_q('^(' + '|'.join(sm.REGION_STARTS) + ')|' + region)}) AS f FROM st0))",
        "st2 AS (SELECT word, stem, p1, CASE WHEN f2 = '' THEN length(stem) ELSE p1 + length(f2) END AS p2 FROM "
        f"(SELECT *, regexp_extract(substr(stem, p1 + 1), {_q(region)}) AS f2 FROM st1))",
        f"st3 AS (SELECT word, p1, p2, {_suffix_step(plural)} AS stem FROM st2)",
        f"st4 AS (SELECT *, stem IN ({stays}) AS done FROM st3)",
        f"st5 AS (SELECT *, CASE WHEN NOT done THEN {_suffix_step(verbs, 'NULL')} END AS c FROM st4)",
        f"st6 AS (SELECT word, p1, p2, done, CASE WHEN done THEN stem WHEN c IS NOT NULL THEN {mended} ELSE "
        f"{_suffix_step([swap(s, 'ee', behind(s, 'p1')) for s in ('eedly', 'eed')])} END AS stem FROM st5)",
        f"st7 AS (SELECT word, p1, p2, done, CASE WHEN NOT done AND {is_like('^.+' + sm.CONSONANT + '[yY]$')} THEN "
        f"{cut(1)} || 'i' ELSE stem END AS stem FROM st6)",
        *[f"st{i} AS (SELECT word, p1, p2, done, {_suffix_step(rules)} AS stem FROM st{i - 1})"
          for i, rules in enumerate((derived, adjectives, endings, last), 8)],
        f"stems AS (SELECT word, CASE WHEN length(word) <= 2 THEN word {special} "
        "ELSE translate(stem, 'Y', 'y') END AS stem FROM st11)"))


GEO = ("geo AS (SELECT n.n_nationkey, n.n_name AS country, r.r_name AS continent "
       "FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)")
COUNTRY_YEAR = GEO + (
    ", country_year AS (SELECT g.country, g.continent, CAST(year(o.o_orderdate) AS INTEGER) AS year, "
    "CAST(sum(CAST(c.c_acctbal AS DECIMAL(18, 2))) AS DOUBLE) / count(*) / 100 AS lifeExp, "
    "CAST(count(DISTINCT o.o_custkey) AS BIGINT) AS pop, "
    "CAST(sum(CAST(o.o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) / count(*) AS gdpPercap FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey "
    "JOIN geo g ON c.c_nationkey = g.n_nationkey GROUP BY 1, 2, 3)")
RATED = GEO + (
    ", ri AS (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, g.country, "
    "p.p_name AS description, p.p_brand AS variety, p.p_size AS points, p.p_retailprice AS price "
    "FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s "
    "ON l.l_suppkey = s.s_suppkey JOIN geo g ON s.s_nationkey = g.n_nationkey)")
CUSTOMER_FEATURES = GEO + (
    ", cf AS (SELECT c.c_custkey, c.c_mktsegment AS segment, g.continent AS region, c.c_acctbal, "
    "o.n_orders, o.avg_price, o.total_spend, "
    "CAST((year(o.last_o) * 12 + month(o.last_o)) - (year(o.first_o) * 12 + month(o.first_o)) "
    "AS INTEGER) AS tenure, "
    "CAST(CASE WHEN o.last_o < TIMESTAMP '2001-01-01' THEN 1 ELSE 0 END AS INTEGER) AS churn "
    "FROM (SELECT o_custkey, count(*) AS n_orders, "
    "CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) / count(*) AS avg_price, "
    "CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total_spend, min(o_orderdate) AS first_o, max(o_orderdate) AS last_o "
    "FROM orders GROUP BY o_custkey) o JOIN customer c ON o.o_custkey = c.c_custkey "
    "JOIN geo g ON c.c_nationkey = g.n_nationkey)")
LABELLED = ("ld AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic "
            "FROM documents d JOIN labels l ON d.doc_id = l.doc_id)")
READINGS = ("readings AS (SELECT event_id, ts, user_id, event_type, nullif(value, 0.01) AS value "
            "FROM events)")
PAGES = "pages_text AS (SELECT source AS document, doc_id AS page, text FROM documents)"
TOKENS = PAGES + (", tokens AS (SELECT document, page, unnest(regexp_extract_all(lower(text), "
                  "'[\\p{L}\\p{N}]+')) AS word FROM pages_text)")
WORDS = TOKENS + ", words AS (SELECT * FROM tokens WHERE NOT regexp_matches(word, '^[0-9]+$'))"
ALL_WORDS = TOKENS + ", all_words AS (SELECT * FROM tokens WHERE word <> '1')"


def wc_ctes() -> str:
    return (WORDS + ", " + stop_values() +
            ", wc AS (SELECT document, word, count(*) AS count FROM words "
            "WHERE word NOT IN (SELECT word FROM sw) GROUP BY document, word)")


def ngram_ctes(n: int) -> str:
    parts = " || ' ' || ".join(f"w[i + {k}]" if k else "w[i]" for k in range(n))
    return PAGES + (
        f", toks AS (SELECT document, regexp_extract_all(lower(text), '{TOKEN}') AS w FROM pages_text)"
        f", grams AS (SELECT document, unnest(list_transform(range(1, len(w) - {n - 2}), "
        f"lambda i: {parts})) AS ngram FROM toks WHERE len(w) >= {n})")


def bigrams_filtered_ctes() -> str:
    return (ngram_ctes(2) + ", " + stop_values() +
            ", bsep AS (SELECT document, split_part(ngram, ' ', 1) AS word1, "
            "split_part(ngram, ' ', 2) AS word2 FROM grams)"
            ", bf AS (SELECT * FROM bsep WHERE word1 NOT IN (SELECT word FROM sw) "
            "AND word2 NOT IN (SELECT word FROM sw))")


def tf_idf_sql(counts_cte: str, term: str) -> str:
    return (f", tt AS (SELECT document, sum(n) AS total FROM {counts_cte} GROUP BY document)"
            f", dd AS (SELECT {term}, count(*) AS df FROM {counts_cte} GROUP BY {term})"
            f", nd AS (SELECT count(*) AS nd FROM tt)"
            f", tfidf AS (SELECT c.document, c.{term}, c.n, c.n / tt.total AS tf, "
            f"ln(nd.nd / dd.df) AS idf, (c.n / tt.total) * ln(nd.nd / dd.df) AS tf_idf "
            f"FROM {counts_cte} c JOIN tt ON c.document = tt.document "
            f"JOIN dd ON c.{term} = dd.{term} CROSS JOIN nd)")


def grid_ctes() -> str:
    return (f"cells AS (SELECT p_partkey // {GRID_WIDTH} AS r, p_partkey % {GRID_WIDTH} AS c, "
            f"p_size > {WALL_SIZE} AS wall FROM part)"
            ", o AS (SELECT r, c FROM cells WHERE NOT wall)"
            ", dirs AS (SELECT * FROM (VALUES ('N', -1, 0), ('S', 1, 0), ('W', 0, -1), ('E', 0, 1)) "
            "AS t(dir, dr, dc))"
            ", e AS (SELECT o.r, o.c, dirs.dir, o.r + dirs.dr AS r2, o.c + dirs.dc AS c2 "
            "FROM o CROSS JOIN dirs JOIN o o2 ON o2.r = o.r + dirs.dr AND o2.c = o.c + dirs.dc)")


def hops_ctes() -> str:
    sr, sc = C.START
    return ("WITH RECURSIVE " + grid_ctes() +
            f", walk(r, c, hops) AS (SELECT r, c, 0 FROM o WHERE r = {sr} AND c = {sc} "
            "UNION SELECT e.r2, e.c2, walk.hops + 1 FROM walk JOIN e ON e.r = walk.r AND e.c = walk.c "
            "WHERE walk.hops < (SELECT count(*) FROM o))"
            ", h AS (SELECT r, c, CAST(min(hops) AS INTEGER) AS hops FROM walk GROUP BY r, c)"
            ", goal AS (SELECT r AS gr, c AS gc FROM h ORDER BY hops DESC, r DESC, c DESC LIMIT 1) ")


LINEITEM_COLS = (("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
                 ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
                 ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
                 ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"))
LINEITEM_NUMERIC = [c for c, t in LINEITEM_COLS if t in ("bigint", "int", "double")]


def describe_sql(cols) -> str:
    parts = []
    for c in cols:
        v = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, count({v}) AS count, avg({v}) AS mean, "
            f"stddev_samp({v}) AS std, min({v}) AS min, quantile_cont({v}, 0.25) AS q25, "
            f"quantile_cont({v}, 0.5) AS q50, quantile_cont({v}, 0.75) AS q75, max({v}) AS max "
            "FROM lineitem")
    return " UNION ALL ".join(parts)


def _boxes(ctes: str, base: str, by: list[str], trimmed: bool = False) -> str:
    """Box statistics of ``value`` in the rows of ``base`` by the columns ``by``."""
    keys = ", ".join(by)
    inside = "value >= lo AND value <= hi"
    n = (f"CAST(sum(CASE WHEN {inside} THEN 1 ELSE 0 END) AS BIGINT) AS n" if trimmed
         else "CAST(count(*) AS BIGINT) AS n")
    tail = "" if trimmed else (
        f", CAST(sum(CASE WHEN {inside} THEN 0 ELSE 1 END) AS BIGINT) AS n_outliers")
    on = " AND ".join(f"b.{k} IS NOT DISTINCT FROM q.{k}" for k in by)
    sql = (with_(ctes, f"base AS (SELECT * FROM ({base}) WHERE value IS NOT NULL)",
                 f"q AS (SELECT {keys}, quantile_cont(value, 0.25) AS q1, "
                 "quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 "
                 f"FROM base GROUP BY {keys})",
                 "j AS (SELECT b.*, q.q1, q.median, q.q3, "
                 "q.q1 - 1.5 * (q.q3 - q.q1) AS lo, q.q3 + 1.5 * (q.q3 - q.q1) AS hi "
                 f"FROM base b JOIN q ON {on})") +
           f"SELECT {keys}, q1, median, q3, {n}, "
           f"min(CASE WHEN {inside} THEN value END) AS whisker_lo, "
           f"max(CASE WHEN {inside} THEN value END) AS whisker_hi{tail} "
           f"FROM j GROUP BY {keys}, q1, median, q3")
    return rnd(sql, "q1", "median", "q3", "whisker_lo", "whisker_hi")


def _box(trimmed: bool) -> str:
    return _boxes(READINGS, "SELECT event_type, value FROM readings", ["event_type"], trimmed)


def _by_each() -> str:
    """cf unpivoted over its categories: (by_column, level, measures...)."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS by_column, CAST({c} AS VARCHAR) AS level, {', '.join(C.MEASURES)} FROM cf"
        for c in C.CATEGORIES)


def _kde(method: str) -> str:
    """Linear binning into cells h / 16 apart, then the kernel over all cells."""
    factor = "power(n, -1.0 / 5)" if method == "scott" else "power(n * 3 / 4.0, -1.0 / 5)"
    sql = (with_("base AS (SELECT CAST(s_acctbal AS DOUBLE) AS x FROM supplier WHERE s_acctbal IS NOT NULL)",
                 "s AS (SELECT count(*) AS n, stddev_samp(x) AS sd, min(x) AS mn, max(x) AS mx FROM base)",
                 f"p AS (SELECT n, mn - sd AS a, mx + sd AS b, {factor} * sd AS h FROM s)",
                 "f AS (SELECT x / (h / 16) AS f, floor(x / (h / 16)) AS c FROM base, p)",
                 "cells AS (SELECT c, sum(w) AS w FROM (SELECT c, 1 - (f - c) AS w FROM f UNION ALL "
                 "SELECT c + 1, f - c FROM f) GROUP BY c)",
                 "g AS (SELECT CAST(i AS INTEGER) AS i, a + i * ((b - a) / 199) AS gx FROM p, range(200) t(i))") +
           "SELECT g.i, g.gx AS x, round(sum(w * exp(-0.5 * power((g.gx - c * (p.h / 16)) / p.h, 2))) / "
           "(p.n * p.h * sqrt(2 * pi())), 12) AS density FROM g CROSS JOIN cells CROSS JOIN p "
           "GROUP BY g.i, g.gx, p.n, p.h")
    return rnd(sql, "x")


def _ri_cols() -> str:
    return ("l_orderkey, l_linenumber, l_partkey, l_suppkey, country, description, variety, "
            "points, price")


def _cheapest_ctes() -> str:
    return (RATED +
            ", top AS (SELECT * FROM ri WHERE points > (SELECT quantile_cont(points, 0.85) FROM ri))"
            ", ch AS (SELECT *, row_number() OVER (ORDER BY price ASC NULLS LAST, l_orderkey, "
            "l_linenumber, l_partkey, l_suppkey) AS rn FROM ri)"
            ", cheapest AS (SELECT " + _ri_cols() + " FROM ch WHERE rn <= (SELECT count(*) FROM top))")


def _selected() -> str:
    return (", cc AS (SELECT country, count(*) AS count FROM ri GROUP BY country)"
            ", sel AS (SELECT country FROM (SELECT country, rank() OVER (ORDER BY count DESC) AS rk "
            "FROM cc) WHERE rk <= 10)")


def _draw(key: str) -> str:
    return f"md5(CAST({key} AS VARCHAR) || '|{C.SEED}')"


def _rule() -> str:
    return (CUSTOMER_FEATURES +
            ", s AS (SELECT c_custkey, churn AS actual, CAST(n_orders < 10 AS INTEGER) AS predicted FROM cf)")


def _stratified() -> str:
    return (CUSTOMER_FEATURES + ", st AS (SELECT *, percent_rank() OVER (PARTITION BY churn "
            f"ORDER BY {_draw('c_custkey')}, c_custkey) < 0.7 AS is_train FROM cf)")


def oracle_sql() -> dict[str, str]:
    """Every SQL text is built by itself: one that fails costs one query."""
    out: dict[str, str] = {}
    for name, build in _texts().items():
        try:
            out[name] = build()
        except Exception as e:  # noqa: BLE001
            warnings.warn(f"no SQL for {name}: {e}", stacklevel=2)
    return out


def _texts() -> dict[str, Callable[[], str]]:
    q: dict[str, Callable[[], str]] = {}
    y, lo = C.YEAR, C.LIFE_EXP_OVER
    # 2.1
    q["scan_csv"] = lambda: rnd("SELECT * FROM customer", "c_acctbal")
    q["scan_csv_inferred"] = lambda: rnd("SELECT *, 'int,string,int,double,string' AS types FROM customer", "c_acctbal")
    q["scan_parquet"] = lambda: ("SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n "
                         "JOIN region r ON n.n_regionkey = r.r_regionkey")
    q["scan_doc_folder"] = lambda: ("SELECT source AS document, CAST(sum(length(text) + 1) AS BIGINT) AS n_chars "
                            "FROM documents GROUP BY source")
    q["dim_stop_words"] = lambda: (with_(TOKENS, stop_values()) +
                           "SELECT word, count(*) AS n FROM tokens WHERE word IN (SELECT word FROM sw) "
                           "GROUP BY word")
    q["typed_literals"] = lambda: ("SELECT n_nationkey, CAST(2.5 AS DOUBLE) AS ratio, TIMESTAMP '2001-06-30' AS seen, "
                           "CAST(0.25 AS FLOAT) AS weight, CAST(9 AS INTEGER) AS rank, CASE WHEN n_nationkey % 2 = 0 "
                           "THEN 'even' ELSE 'odd' END AS parity, 'note' AS remark FROM nation")
    q["sink_roundtrip"] = lambda: rnd(with_(READINGS) + "SELECT * FROM readings", "value")
    q["date_spine"] = lambda: (with_(
        "span AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders)",
        "spine AS (SELECT CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), "
        "INTERVAL 1 DAY)) AS DATE) AS ds FROM span)",
        "cnt AS (SELECT CAST(o_orderdate AS DATE) AS ds, count(*) AS n FROM orders GROUP BY 1)") +
        "SELECT s.ds, CAST(coalesce(c.n, 0) AS BIGINT) AS n FROM spine s LEFT JOIN cnt c ON s.ds = c.ds")
    q["int_range"] = lambda: (with_(
        "yy AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS k FROM orders)",
        "span AS (SELECT min(k) AS a, max(k) AS b FROM yy)",
        "spine AS (SELECT CAST(unnest(generate_series(a, b)) AS INTEGER) AS year FROM span)",
        "cnt AS (SELECT k AS year, count(*) AS n FROM yy GROUP BY k)") +
        "SELECT s.year, CAST(coalesce(c.n, 0) AS BIGINT) AS n FROM spine s LEFT JOIN cnt c ON s.year = c.year")
    q["grid_points"] = lambda: rnd(
        with_("span AS (SELECT CAST(min(value) AS DOUBLE) AS a, CAST(max(value) AS DOUBLE) AS b FROM events)") +
        "SELECT CAST(i AS INTEGER) AS i, a + i * ((b - a) / 99) AS x FROM span, range(100) t(i)", "x")
    # 2.2
    q["profile_shape"] = lambda: ("SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_cols FROM lineitem")
    q["profile_types"] = lambda: " UNION ALL ".join(
        f"SELECT {i + 1} AS position, '{c}' AS column_name, '{t}' AS data_type, "
        f"count({c}) AS non_null FROM lineitem" for i, (c, t) in enumerate(LINEITEM_COLS))
    q["head_n"] = lambda: rnd(with_(COUNTRY_YEAR) + "SELECT * FROM country_year ORDER BY country, year LIMIT 6",
                      "lifeExp", "gdpPercap")
    q["tail_n"] = lambda: rnd(with_(COUNTRY_YEAR) + "SELECT * FROM (SELECT * FROM country_year "
                      "ORDER BY country DESC, year DESC LIMIT 6) ORDER BY country, year",
                      "lifeExp", "gdpPercap")
    q["describe_numeric"] = lambda: rnd(describe_sql(LINEITEM_NUMERIC), "mean", "std", "min", "q25",
                                "q50", "q75", "max")
    q["describe_categorical"] = lambda: (with_(
        "lng AS (SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value FROM orders "
        "UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders)",
        "cnt AS (SELECT column_name, value, count(*) AS k FROM lng WHERE value IS NOT NULL GROUP BY 1, 2)") +
        "SELECT column_name, CAST(sum(k) AS BIGINT) AS count, count(*) AS unique, "
        "first(value ORDER BY k DESC, value) AS top, max(k) AS freq FROM cnt GROUP BY column_name")
    q["null_counts"] = lambda: with_(READINGS) + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(sum(CASE WHEN {c} IS NULL{extra} THEN 1 ELSE 0 END) "
        f"AS BIGINT) AS n_missing FROM readings"
        for c, extra in (("event_id", ""), ("ts", ""), ("user_id", ""), ("event_type", ""),
                         ("value", " OR isnan(value)")))
    q["any_missing"] = lambda: (with_(READINGS) + "SELECT coalesce(max(value IS NULL OR isnan(value)), false) "
                        "AS any_missing FROM readings")
    q["low_cardinality"] = lambda: with_(LABELLED) + "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM ld"
        for c in ("doc_id", "lang", "source", "n_chars", "quality", "toxic")) + ") WHERE n_distinct < 10"
    q["value_counts"] = lambda: (with_(READINGS) + f"SELECT event_type, count(*) AS n FROM readings "
                         f"WHERE value >= {C.HIGH_VALUE} AND event_type IS NOT NULL GROUP BY event_type")
    q["min_max"] = lambda: rnd("SELECT min(s_acctbal) AS min_salary, max(s_acctbal) AS max_salary FROM supplier",
                       "min_salary", "max_salary")
    cases = " ".join(f"WHEN s_suppkey = {k} THEN {v}" for k, v in C.SALARY_FIXES.items())
    upd = f"CAST(CASE {cases} ELSE s_acctbal END AS DOUBLE) AS s_acctbal"
    fixed = ", ".join(str(k) for k in C.SALARY_FIXES)
    q["row_lookup"] = lambda: rnd(f"SELECT s_suppkey, s_name, {upd} FROM supplier WHERE s_suppkey IN ({fixed})",
                          "s_acctbal")
    # 2.3
    cy = with_(COUNTRY_YEAR)
    q["select_cols"] = lambda: cy + "SELECT country, year, pop FROM country_year"
    q["drop_cols"] = lambda: rnd(cy + "SELECT country, year, lifeExp, pop, gdpPercap FROM country_year",
                         "lifeExp", "gdpPercap")
    q["mutate_col"] = lambda: rnd(cy + f"SELECT country, year, pop, gdpPercap, pop * gdpPercap AS gdp "
                          f"FROM country_year WHERE year = {y}", "gdpPercap", "gdp")
    q["transmute_col"] = lambda: rnd(cy + f"SELECT pop * gdpPercap AS gdp FROM country_year WHERE year = {y}", "gdp")
    gdp = cy + (", g AS (SELECT country, pop, gdpPercap, pop * gdpPercap AS gdp, rank() OVER (ORDER BY "
                f"pop * gdpPercap DESC) AS rk FROM country_year WHERE year = {y}) ")
    q["top_gdp"] = lambda: rnd(gdp + f"SELECT country, pop, gdpPercap, gdp FROM g WHERE rk <= {C.TOP_GDP}",
                       "gdpPercap", "gdp")
    q["top_gdp_only"] = lambda: rnd(gdp + f"SELECT gdp FROM g WHERE rk <= {C.TOP_GDP}", "gdp")
    q["insert_col"] = lambda: rnd(cy + "SELECT country, continent, pop * gdpPercap AS gdp, year, lifeExp, pop, "
                          "gdpPercap FROM country_year", "gdp", "lifeExp", "gdpPercap")
    q["point_update"] = lambda: rnd(f"SELECT s_suppkey, s_name, {upd} FROM supplier", "s_acctbal")
    q["if_else_flag"] = lambda: rnd(cy + f"SELECT country, lifeExp, CASE WHEN lifeExp > {lo} THEN 'Y' ELSE 'N' END "
                            f"AS over FROM country_year WHERE year = {y}", "lifeExp")
    q["recode_values"] = lambda: (with_(CUSTOMER_FEATURES) +
                          "SELECT c_custkey, CASE segment WHEN 'AUTOMOBILE' THEN 'AUTO' WHEN 'AMERICA' "
                          "THEN 'AMERICAS' ELSE segment END AS segment, CASE region WHEN 'AUTOMOBILE' "
                          "THEN 'AUTO' WHEN 'AMERICA' THEN 'AMERICAS' ELSE region END AS region FROM cf")
    q["bin_tenure"] = lambda: (with_(CUSTOMER_FEATURES) +
                       "SELECT c_custkey, tenure, CASE WHEN tenure >= 0 AND tenure <= 12 THEN '0-12 Month' "
                       "WHEN tenure > 12 AND tenure <= 24 THEN '12-24 Month' WHEN tenure > 24 AND tenure <= 48 "
                       "THEN '24-48 Month' WHEN tenure > 48 AND tenure <= 60 THEN '48-60 Month' "
                       "WHEN tenure > 60 THEN '> 60 Month' END AS tenure_group FROM cf")
    q["cast_cols"] = lambda: ("SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS INTEGER) AS user_id, "
                      "TRY_CAST(event_type AS INTEGER) AS event_type, TRY_CAST(props AS INTEGER) AS props "
                      "FROM events")
    q["filter_conj"] = lambda: rnd(cy + f"SELECT country, year, lifeExp FROM country_year WHERE year = {y} "
                           f"AND country = '{C.COUNTRIES[0]}'", "lifeExp")
    q["filter_in"] = lambda: rnd(cy + f"SELECT country, year, lifeExp FROM country_year WHERE year = {y} "
                         f"AND country IN ({', '.join(_q(c) for c in C.COUNTRIES)})", "lifeExp")
    q["filter_threshold"] = lambda: rnd(with_(READINGS) + f"SELECT * FROM readings WHERE value >= {C.HIGH_VALUE}",
                                "value")
    q["filter_query_string"] = lambda: (with_(CUSTOMER_FEATURES) +
                                "SELECT c_custkey, n_orders, tenure FROM cf WHERE n_orders < tenure")
    q["filter_regex"] = lambda: (with_(TOKENS) + "SELECT word, count(*) AS n FROM tokens "
                         "WHERE NOT regexp_matches(word, '\\d') GROUP BY word")
    q["complete_cases"] = lambda: rnd(with_(READINGS) + "SELECT * FROM readings WHERE event_id IS NOT NULL AND "
                              "ts IS NOT NULL AND user_id IS NOT NULL AND event_type IS NOT NULL AND "
                              "value IS NOT NULL", "value")
    q["above_quantile"] = lambda: rnd(with_(RATED) + "SELECT * FROM ri WHERE points > "
                              f"(SELECT quantile_cont(points, {C.QUANTILE}) FROM ri)", "price")
    stats = (("count", "CAST(count({c}) AS DOUBLE)"),
             ("mean", "avg({c})"),
             ("std", "stddev_samp({c})"),
             ("min", "min({c})"), ("q25", "quantile_cont({c}, 0.25)"), ("q50", "quantile_cont({c}, 0.5)"),
             ("q75", "quantile_cont({c}, 0.75)"), ("max", "max({c})"))
    q["transpose_summary"] = lambda: rnd(" UNION ALL ".join(
        f"SELECT '{name}' AS field, {f.format(c='l_discount')} AS l_discount, "
        f"{f.format(c='l_quantity')} AS l_quantity FROM lineitem" for name, f in stats),
        "l_discount", "l_quantity")
    # 2.4
    q["anti_join_stop_words"] = lambda: (with_(WORDS, stop_values()) +
                                 "SELECT document, count(*) AS n FROM words "
                                 "WHERE word NOT IN (SELECT word FROM sw) GROUP BY document")
    q["semi_join_top_countries"] = lambda: (with_(RATED + _selected()) +
                                    "SELECT country, points FROM ri WHERE country IN (SELECT country FROM sel)")
    q["anti_join_top_countries"] = lambda: rnd(with_(RATED + _selected()) +
                                       "SELECT country, quantile_cont(CAST(points AS DOUBLE), 0.5) AS median "
                                       "FROM ri WHERE country NOT IN (SELECT country FROM sel) GROUP BY country",
                                       "median")
    q["median_top_varieties"] = lambda: rnd(with_(
        RATED, "vc AS (SELECT variety, rank() OVER (ORDER BY count(*) DESC) AS rk FROM ri GROUP BY variety)",
        "m AS (SELECT variety, quantile_cont(CAST(points AS DOUBLE), 0.5) AS median FROM ri WHERE variety IN "
        f"(SELECT variety FROM vc WHERE rk <= {C.TOP_VARIETIES}) GROUP BY variety)") +
        "SELECT variety, median, row_number() OVER (ORDER BY median, variety) AS sort_key FROM m", "median")
    q["box_top_countries"] = lambda: _boxes(RATED + _selected(), "SELECT country, CAST(points AS DOUBLE) AS value FROM ri "
                                    "WHERE country IN (SELECT country FROM sel)", ["country"])
    q["sentiment_join"] = lambda: (with_(wc_ctes(), polarity_ctes()) +
                           "SELECT wc.word, wc.document, wc.count, lex.sentiment FROM wc "
                           "JOIN lex ON wc.word = lex.word")
    q["nearest_centroid"] = lambda: rnd(with_(
        "qs AS (SELECT quantile_cont(s_acctbal, [0.125, 0.375, 0.625, 0.875]) AS v FROM supplier)",
        "book AS (SELECT CAST(i - 1 AS INTEGER) AS code, v[i] AS center FROM qs, range(1, 5) t(i))",
        "d AS (SELECT s.s_suppkey, b.code, abs(s.s_acctbal - b.center) AS dist, row_number() OVER "
        "(PARTITION BY s.s_suppkey ORDER BY abs(s.s_acctbal - b.center), b.code) AS rn "
        "FROM supplier s CROSS JOIN book b)") +
        "SELECT s_suppkey, code, dist FROM d WHERE rn = 1", "dist")
    q["grid_edges"] = lambda: with_(grid_ctes()) + "SELECT r, c, dir, r2, c2 FROM e"
    # 2.5
    q["global_mean"] = lambda: rnd(cy + "SELECT avg(lifeExp) AS avgLifeExp FROM country_year", "avgLifeExp")
    q["group_mean"] = lambda: rnd(cy + f"SELECT continent, avg(lifeExp) AS avgLifeExp, CASE WHEN avg(lifeExp) > {lo} "
                          f"THEN 'Y' ELSE 'N' END AS over FROM country_year WHERE year = {y} "
                          "GROUP BY continent ORDER BY avgLifeExp DESC", "avgLifeExp")
    q["group_mean_all"] = lambda: rnd(with_(LABELLED) + "SELECT quality, avg(doc_id) AS doc_id, avg(n_chars) AS n_chars, "
                              "avg(toxic) AS toxic FROM ld GROUP BY quality", "doc_id", "n_chars", "toxic")
    q["group_count"] = lambda: with_(RATED) + "SELECT country, count(*) AS count FROM ri GROUP BY country"
    q["weighted_count"] = lambda: (with_(wc_ctes(), polarity_ctes()) +
                           "SELECT wc.document, lex.sentiment, wc.word, CAST(sum(wc.count) AS BIGINT) AS n "
                           "FROM wc JOIN lex ON wc.word = lex.word GROUP BY 1, 2, 3")
    q["group_median"] = lambda: rnd(with_(RATED) + "SELECT country, quantile_cont(CAST(points AS DOUBLE), 0.5) AS median "
                            "FROM ri GROUP BY country", "median")
    q["population_variance"] = lambda: rnd(
        "SELECT min(s_acctbal) AS min, max(s_acctbal) AS max, avg(s_acctbal) AS mean, "
        "var_pop(s_acctbal) AS var, stddev_pop(s_acctbal) AS std FROM supplier",
        "min", "max", "mean", "var", "std")
    q["unique_words_by_doc"] = lambda: (with_(ALL_WORDS) +
                                "SELECT document, count(DISTINCT word) AS unique FROM all_words GROUP BY document")
    q["quantile_interp"] = lambda: rnd(with_(RATED) + "SELECT quantile_cont(CAST(points AS DOUBLE), 0.85) AS points_q85, "
                               "quantile_cont(price, 0.85) AS price_q85 FROM ri", "points_q85", "price_q85")
    cfcols = ["c_acctbal", "n_orders", "avg_price", "total_spend", "tenure"]
    q["corr_matrix"] = lambda: rnd(with_(CUSTOMER_FEATURES) + " UNION ALL ".join(
        f"SELECT '{a}' AS var1, '{b}' AS var2, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS corr FROM cf"
        for a in cfcols for b in cfcols), "corr")
    q["box_stats"] = lambda: _box(False)
    q["box_stats_trimmed"] = lambda: _box(True)
    q["histogram_10"] = lambda: rnd(with_(
        READINGS, "base AS (SELECT value FROM readings WHERE value IS NOT NULL)",
        "s AS (SELECT min(value) AS lo, max(value) AS hi FROM readings)",
        "b AS (SELECT CAST(least(floor((value - lo) / ((hi - lo) / 10)), 9) AS INTEGER) AS bin "
        "FROM base CROSS JOIN s)",
        "c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin)") +
        "SELECT CAST(t.i AS INTEGER) AS bin, lo + t.i * ((hi - lo) / 10) AS bin_lo, "
        "lo + (t.i + 1) * ((hi - lo) / 10) AS bin_hi, CAST(coalesce(c.n, 0) AS BIGINT) AS n "
        "FROM range(10) t(i) CROSS JOIN s LEFT JOIN c ON c.bin = t.i", "bin_lo", "bin_hi")
    q["group_mean_by_each"] = lambda: rnd(
        with_(CUSTOMER_FEATURES, f"e AS ({_by_each()})") + "SELECT by_column, level, " +
        ", ".join(f"avg({c}) AS {c}" for c in C.MEASURES) + " FROM e GROUP BY by_column, level", *C.MEASURES)
    q["box_stats_by_each"] = lambda: _boxes(
        CUSTOMER_FEATURES + f", e AS ({_by_each()})",
        " UNION ALL ".join(f"SELECT by_column, level, '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM e"
                           for c in C.MEASURES), ["by_column", "level", "column_name"])
    q["histogram_all"] = lambda: rnd(with_(
        CUSTOMER_FEATURES,
        "lng AS (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS v FROM cf"
                                        for c in C.MEASURES) + ")",
        "s AS (SELECT column_name, min(v) AS lo, max(v) AS hi FROM lng GROUP BY column_name)",
        "b AS (SELECT column_name, CAST(least(floor((v - lo) / ((hi - lo) / 10)), 9) AS INTEGER) AS bin, "
        "count(*) AS n FROM lng JOIN s USING (column_name) WHERE v IS NOT NULL GROUP BY 1, 2)") +
        "SELECT s.column_name, CAST(t.i AS INTEGER) AS bin, lo + t.i * ((hi - lo) / 10) AS bin_lo, "
        "lo + (t.i + 1) * ((hi - lo) / 10) AS bin_hi, CAST(coalesce(b.n, 0) AS BIGINT) AS n "
        "FROM s CROSS JOIN range(10) t(i) LEFT JOIN b ON b.column_name = s.column_name AND b.bin = t.i",
        "bin_lo", "bin_hi")
    q["percent_share"] = lambda: rnd(with_(
        CUSTOMER_FEATURES,
        "lng AS (SELECT 'segment' AS variable, segment AS level FROM cf UNION ALL "
        "SELECT 'region', region FROM cf UNION ALL SELECT 'churn', CAST(churn AS VARCHAR) FROM cf)",
        "c AS (SELECT variable, level, count(*) AS n FROM lng GROUP BY 1, 2)") +
        "SELECT variable, level, n, CAST(100.0 AS DOUBLE) * n / sum(n) OVER (PARTITION BY variable) AS pct "
        "FROM c", "pct")
    q["confusion_matrix"] = lambda: (with_(_rule(), "lv AS (SELECT actual AS v FROM s UNION SELECT predicted FROM s)") +
                             "SELECT a.v AS actual, p.v AS predicted, CAST(count(s.actual) AS BIGINT) AS n "
                             "FROM lv a CROSS JOIN lv p LEFT JOIN s ON s.actual = a.v AND s.predicted = p.v "
                             "GROUP BY 1, 2")
    cs = (with_(_rule(),
                "c AS (SELECT sum(CASE WHEN actual = 0 AND predicted = 0 THEN 1 ELSE 0 END) AS tp, "
                "sum(CASE WHEN actual <> 0 AND predicted = 0 THEN 1 ELSE 0 END) AS fp, "
                "sum(CASE WHEN actual = 0 AND predicted <> 0 THEN 1 ELSE 0 END) AS fn, "
                "sum(CASE WHEN actual <> 0 AND predicted <> 0 THEN 1 ELSE 0 END) AS tn FROM s)",
                "d AS (SELECT CAST(tp AS DOUBLE) AS tp, CAST(fp AS DOUBLE) AS fp, CAST(fn AS DOUBLE) AS fn, "
                "CAST(tn AS DOUBLE) AS tn, CAST(tp + fp + fn + tn AS DOUBLE) AS n FROM c)",
                "e AS (SELECT *, (tp + tn) / n AS acc, ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / (n * n) AS pe, "
                "tp / (tp + fn) AS sens, tn / (tn + fp) AS spec FROM d)") +
          "SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, "
          "CAST(tn AS BIGINT) AS tn, acc AS accuracy, (acc - pe) / (1 - pe) AS kappa, sens AS sensitivity, "
          "spec AS specificity, tp / (tp + fp) AS ppv, tn / (tn + fn) AS npv, (tp + fn) / n AS prevalence, "
          "(sens + spec) / 2 AS balanced_accuracy FROM e")
    q["confusion_stats"] = lambda: rnd(cs, "accuracy", "kappa", "sensitivity", "specificity", "ppv", "npv",
                               "prevalence", "balanced_accuracy")
    q["accuracy"] = lambda: rnd(with_(_rule()) + "SELECT avg(CAST(actual = predicted AS DOUBLE)) AS accuracy, "
                        "1 - avg(CAST(actual = predicted AS DOUBLE)) AS misclassification FROM s",
                        "accuracy", "misclassification")
    q["rmse"] = lambda: rnd(with_(CUSTOMER_FEATURES,
                          "fit AS (SELECT regr_slope(total_spend, n_orders) AS b, "
                          "regr_intercept(total_spend, n_orders) AS a FROM cf)",
                          "m AS (SELECT avg(power(total_spend - (a + b * n_orders), 2)) AS mse, "
                          "var_pop(total_spend) AS vy FROM cf CROSS JOIN fit)") +
                    "SELECT round(sqrt(mse), 3) AS rmse, 1 - mse / vy AS r2 FROM m", "rmse", "r2")
    q["reorder_by_median"] = lambda: rnd(with_(RATED) +
                                 "SELECT country, median, row_number() OVER (ORDER BY median, country) AS sort_key "
                                 "FROM (SELECT country, quantile_cont(CAST(points AS DOUBLE), 0.5) AS median "
                                 "FROM ri GROUP BY country)", "median")
    # 2.6
    q["row_number_by_doc"] = lambda: ("SELECT source AS document, doc_id AS page, row_number() OVER "
                              "(PARTITION BY source ORDER BY doc_id) AS linenumber FROM documents")
    q["distinct_over_group"] = lambda: (with_(ALL_WORDS,
                                      "u AS (SELECT document, count(DISTINCT word) AS unique FROM all_words "
                                      "GROUP BY document)") +
                                "SELECT w.document, u.unique, count(*) AS n FROM all_words w "
                                "JOIN u ON w.document = u.document GROUP BY 1, 2")
    q["cumsum_series"] = lambda: rnd(with_(
        "daily AS (SELECT CAST(o_orderdate AS DATE) AS ds, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS v "
        "FROM orders GROUP BY 1)") +
        "SELECT ds, CAST(v AS DOUBLE) AS value, CAST(sum(v) OVER (ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING "
        "AND CURRENT ROW) AS DOUBLE) AS cumsum FROM daily", "value", "cumsum")
    q["cumsum_by_group"] = lambda: (cy + "SELECT country, year, pop, CAST(sum(pop) OVER (PARTITION BY country "
                            "ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_pop "
                            "FROM country_year")
    tfidf = (with_(ALL_WORDS + ", cnt AS (SELECT document, word, count(*) AS n FROM all_words "
                   "GROUP BY document, word)" + tf_idf_sql("cnt", "word")))
    q["tf_idf"] = lambda: rnd(tfidf + "SELECT * FROM tfidf", "tf", "idf", "tf_idf")
    q["ecdf"] = lambda: rnd(with_(READINGS,
                          "k AS (SELECT value, count(*) AS k FROM readings WHERE value IS NOT NULL GROUP BY value)",
                          "t AS (SELECT sum(k) AS total FROM k)") +
                    "SELECT value, CAST(sum(k) OVER (ORDER BY value) AS BIGINT) AS n_le, "
                    "sum(k) OVER (ORDER BY value) / (SELECT total FROM t) AS ecdf FROM k", "value", "ecdf")
    q["ecdf_grid"] = lambda: rnd(with_(
        READINGS, "base AS (SELECT value FROM readings WHERE value IS NOT NULL)",
        "s AS (SELECT count(*) AS n, stddev_pop(value) AS sd, min(value) AS mn, max(value) AS mx FROM base)",
        "p AS (SELECT n, mn - sd AS a, mx + sd AS b FROM s)",
        "g AS (SELECT CAST(i AS INTEGER) AS i, a + i * ((b - a) / 99) AS x, n FROM p, range(100) t(i))") +
        "SELECT g.i, g.x, (SELECT count(*) FROM base WHERE base.value <= g.x) / g.n AS ecdf FROM g",
        "x", "ecdf")
    # 2.7
    q["sort_multi"] = lambda: rnd(with_(READINGS) +
                          "SELECT event_id, event_type, value, row_number() OVER (ORDER BY event_type ASC NULLS LAST, "
                          "value DESC NULLS LAST, event_id) AS pos FROM readings", "value")
    q["top_n_ties"] = lambda: rnd(cy + "SELECT country, year, lifeExp FROM (SELECT *, rank() OVER (ORDER BY lifeExp DESC) "
                          f"AS rk FROM country_year WHERE year = {y} AND lifeExp IS NOT NULL) WHERE rk <= {C.TOP_N}",
                          "lifeExp")
    q["top_n_by_group"] = lambda: rnd(tfidf + "SELECT document, word, n, tf, idf, tf_idf FROM (SELECT *, rank() OVER "
                              "(PARTITION BY document ORDER BY tf_idf DESC) AS rk FROM tfidf) "
                              f"WHERE rk <= {C.TOP_N}", "tf", "idf", "tf_idf")
    q["limit_by_count"] = lambda: rnd(with_(_cheapest_ctes()) + "SELECT * FROM cheapest", "price")
    q["top_words"] = lambda: (with_(ALL_WORDS) + "SELECT word, count(*) AS n FROM all_words GROUP BY word "
                      "HAVING count(*) >= 10 ORDER BY n DESC, word LIMIT 50")
    q["sample_n"] = lambda: rnd(f"SELECT * FROM customer ORDER BY {_draw('c_custkey')}, c_custkey LIMIT 5", "c_acctbal")
    q["split_random"] = lambda: (with_(CUSTOMER_FEATURES) +
                         f"SELECT c_custkey, {_draw('c_custkey')} < '{draw_below(0.8)}' AS is_train FROM cf")
    q["split_stratified"] = lambda: with_(_stratified()) + "SELECT c_custkey, churn, is_train FROM st"
    # 2.8
    q["intersect_keys"] = lambda: (with_(RATED + _selected(),
                                 "med AS (SELECT country, quantile_cont(CAST(points AS DOUBLE), 0.5) AS median "
                                 "FROM ri GROUP BY country)",
                                 "fst AS (SELECT country, rank() OVER (ORDER BY median DESC, country) AS rank_in_first "
                                 "FROM med)") +
                           "SELECT country, CAST(rank_in_first AS BIGINT) AS rank_in_first FROM fst "
                           "WHERE country IN (SELECT country FROM sel)")
    q["good_value"] = lambda: rnd(with_(_cheapest_ctes()) + f"SELECT {_ri_cols()} FROM top INTERSECT "
                          f"SELECT {_ri_cols()} FROM cheapest", "price")
    q["complement_rows"] = lambda: rnd(with_(_stratified()) +
                               "SELECT c_custkey, segment, region, c_acctbal, n_orders, avg_price, total_spend, "
                               "tenure, churn FROM st WHERE NOT is_train", "c_acctbal", "avg_price", "total_spend")
    # 2.9
    q["unite_cols"] = lambda: (with_(bigrams_filtered_ctes()) +
                       "SELECT word1 || ' ' || word2 AS bigram, count(*) AS n FROM bf GROUP BY 1")
    q["separate_cols"] = lambda: (with_(ngram_ctes(2)) +
                          "SELECT split_part(ngram, ' ', 1) AS word1, split_part(ngram, ' ', 2) AS word2, "
                          "count(*) AS n FROM grams GROUP BY 1, 2")
    q["stem_counts"] = lambda: (with_(WORDS, stem_ctes("words")) + "SELECT stem, count(*) AS n FROM words "
                        "JOIN stems USING (word) GROUP BY stem")
    q["polarity_list"] = lambda: rnd(with_(WORDS, stop_values(), polarity_ctes()) +
                             "SELECT axis, word, sentiment, weight FROM pol", "weight")
    q["reorder_within"] = lambda: rnd(tfidf + ", top AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY document "
                              f"ORDER BY tf_idf DESC) AS rk FROM tfidf) WHERE rk <= {C.TOP_N}) "
                              "SELECT document, word, tf_idf, word || '___' || document AS label, "
                              "avg(tf_idf) OVER (PARTITION BY word || '___' || document) AS label_key, "
                              "regexp_replace(word || '___' || document, '___.+$', '') AS shown FROM top",
                              "tf_idf", "label_key")
    q["clean_text"] = lambda: (with_(
        PAGES,
        "a AS (SELECT row_number() OVER () AS r, document, page, lower(regexp_replace(regexp_replace(regexp_replace("
        "text, '[[:punct:]]', '', 'g'), '[/@|]', ' ', 'g'), '\\d', '', 'g')) AS t FROM pages_text)",
        "k AS (SELECT r, document, page, list_filter(string_split_regex(t, '\\s+'), "
        f"lambda w: w <> '' AND NOT list_contains({stop_list()}, w)) AS ws FROM a)",
        "each AS (SELECT r, i, ws[i] AS word FROM (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM k))",
        stem_ctes("each"),
        "j AS (SELECT r, string_agg(stem, ' ' ORDER BY i) AS clean FROM each JOIN stems USING (word) GROUP BY r)") +
        "SELECT document, page, CASE WHEN ws IS NOT NULL THEN coalesce(clean, '') END AS clean "
        "FROM k LEFT JOIN j USING (r)")
    q["unnest_pages"] = lambda: ("SELECT document, CAST(i AS BIGINT) AS page, pages[i] AS text FROM "
                         "(SELECT doc_id AS document, string_split(text, chr(10)) AS pages, "
                         "unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)")
    # 2.10
    q["tokenize"] = lambda: with_(TOKENS) + "SELECT document, page, word FROM tokens"
    q["tokenize_no_numbers"] = lambda: with_(WORDS) + "SELECT document, page, word FROM words"
    q["word_counts"] = lambda: with_(wc_ctes()) + "SELECT * FROM wc"
    q["tokens_by_doc"] = lambda: with_(WORDS) + "SELECT document, count(*) AS total_lines FROM words GROUP BY document"
    q["bigram_counts"] = lambda: with_(ngram_ctes(2)) + "SELECT ngram AS bigram, count(*) AS n FROM grams GROUP BY 1"
    q["trigram_counts"] = lambda: (with_(ngram_ctes(3), stop_values(),
                                 "t3 AS (SELECT split_part(ngram, ' ', 1) AS word1, split_part(ngram, ' ', 2) AS word2, "
                                 "split_part(ngram, ' ', 3) AS word3 FROM grams)") +
                           "SELECT word1, word2, word3, count(*) AS n FROM t3 WHERE word1 NOT IN (SELECT word FROM sw) "
                           "AND word2 NOT IN (SELECT word FROM sw) AND word3 NOT IN (SELECT word FROM sw) "
                           "GROUP BY 1, 2, 3")
    q["bigram_counts_filtered"] = lambda: (with_(bigrams_filtered_ctes()) +
                                   "SELECT word1, word2, count(*) AS n FROM bf GROUP BY 1, 2")
    q["bigram_tf_idf"] = lambda: rnd(with_(bigrams_filtered_ctes() +
                                   ", bc AS (SELECT document, word1 || ' ' || word2 AS bigram, count(*) AS n "
                                   "FROM bf GROUP BY 1, 2)" + tf_idf_sql("bc", "bigram")) +
                             "SELECT document, bigram, n, tf, idf, tf_idf FROM (SELECT *, rank() OVER "
                             "(PARTITION BY document ORDER BY tf_idf DESC) AS rk FROM tfidf) "
                             f"WHERE rk <= {C.TOP_N}", "tf", "idf", "tf_idf")
    q["bigram_edges"] = lambda: (with_(bigrams_filtered_ctes()) +
                         "SELECT word1, word2, count(*) AS n FROM bf GROUP BY 1, 2 HAVING count(*) > 20 "
                         "AND NOT regexp_matches(word1, '\\d') AND NOT regexp_matches(word2, '\\d')")
    q["sentiment_contribution"] = lambda: (with_(wc_ctes(), polarity_ctes()) +
                                   "SELECT document, sentiment, word, CAST(CASE WHEN sentiment = 'negative' "
                                   "THEN -n ELSE n END AS BIGINT) AS n FROM (SELECT wc.document, lex.sentiment, "
                                   "wc.word, sum(wc.count) AS n FROM wc JOIN lex ON wc.word = lex.word "
                                   "GROUP BY 1, 2, 3) WHERE n >= 10")
    q["doc_term_matrix"] = lambda: (with_(wc_ctes()) +
                            "SELECT document, dense_rank() OVER (ORDER BY word) AS term_id, word AS term, "
                            "count AS n FROM wc")
    # 2.11
    q["kde_scott"] = lambda: _kde("scott")
    q["kde_silverman"] = lambda: _kde("silverman")
    q["kde_2d"] = lambda: rnd(with_(
        "base AS (SELECT CAST(s_acctbal AS DOUBLE) AS px, CAST(s_nationkey AS DOUBLE) AS py FROM supplier "
        "WHERE s_acctbal IS NOT NULL AND s_nationkey IS NOT NULL)",
        "s AS (SELECT count(*) AS n, var_samp(px) AS vx, var_samp(py) AS vy, covar_samp(px, py) AS cxy, "
        "min(px) AS x0, max(px) AS x1, min(py) AS y0, max(py) AS y1 FROM base)",
        "f AS (SELECT *, power(power(n, -1.0 / 6), 2) AS f2 FROM s)",
        "m AS (SELECT *, vx * f2 AS sxx, vy * f2 AS syy, cxy * f2 AS sxy FROM f)",
        "d AS (SELECT *, sxx * syy - sxy * sxy AS det, -sxy / syy AS c, sqrt(syy) AS hy, "
        "sqrt((sxx * syy - sxy * sxy) / syy) AS hu FROM m)",
        "pos AS (SELECT (px + c * py) / (hu / 8) AS fu, py / (hy / 8) AS fy FROM base, d)",
        "low AS (SELECT fu, fy, floor(fu) AS cu, floor(fy) AS cy FROM pos)",
        "cells AS (SELECT cu, cy, sum(w) AS w FROM ("
        "SELECT cu, cy, (1 - (fu - cu)) * (1 - (fy - cy)) AS w FROM low UNION ALL "
        "SELECT cu + 1, cy, (fu - cu) * (1 - (fy - cy)) FROM low UNION ALL "
        "SELECT cu, cy + 1, (1 - (fu - cu)) * (fy - cy) FROM low UNION ALL "
        "SELECT cu + 1, cy + 1, (fu - cu) * (fy - cy) FROM low) GROUP BY cu, cy)",
        "g AS (SELECT CAST(gi // 100 AS INTEGER) AS i, CAST(gi % 100 AS INTEGER) AS j, "
        "x0 + (gi // 100) * ((x1 - x0) / 99) AS gx, y0 + (gi % 100) * ((y1 - y0) / 99) AS gy "
        "FROM d, range(10000) t(gi))") +
        "SELECT g.i, g.j, g.gx AS x, g.gy AS y, round(sum(w * exp(-0.5 * (power((g.gx + d.c * g.gy - cu * (d.hu / 8)) "
        "/ d.hu, 2) + power((g.gy - cy * (d.hy / 8)) / d.hy, 2)))) / (d.n * 2 * pi() * sqrt(d.det)), 12) AS density "
        "FROM g CROSS JOIN cells CROSS JOIN d GROUP BY g.i, g.j, g.gx, g.gy, d.n, d.det", "x", "y")
    q["smooth_trend"] = lambda: with_(
        RATED, "m AS (SELECT CAST(points AS DOUBLE) AS x, count(*) AS n, sum(price) AS t FROM ri "
               "WHERE points IS NOT NULL AND price IS NOT NULL GROUP BY points)",
        "s AS (SELECT sum(n) AS n, min(x) AS lo, max(x) AS hi, greatest(1, floor(0.75 * sum(n) + 1e-5)) AS q FROM m)",
        "p AS (SELECT i, lo + i * ((hi - lo) / 79) AS g, x, m.n, t, (x - (lo + i * ((hi - lo) / 79))) / ((hi - lo) / 2) "
        "AS e, q FROM m, s, range(80) r(i))",
        "u AS (SELECT *, sum(n) OVER (PARTITION BY i ORDER BY round(abs(e), 12)) AS upto FROM p)",
        "h AS (SELECT i, min(abs(e)) AS h FROM u WHERE upto >= q GROUP BY i)",
        "w AS (SELECT u.*, CASE WHEN abs(e) < h THEN power(1 - power(abs(e) / h, 3), 3) ELSE 0 END AS w FROM u JOIN h USING (i))",
        "k AS (SELECT i, g, sum(w * n) AS m0, sum(w * n * e) AS m1, sum(w * n * e * e) AS m2, sum(w * n * e * e * e) AS m3, "
        "sum(w * n * e * e * e * e) AS m4, sum(w * t) AS r0, sum(w * t * e) AS r1, sum(w * t * e * e) AS r2 FROM w GROUP BY i, g)") + (
        "SELECT CAST(i AS INTEGER) AS i, round(g, 6) AS x, round((r0 * (m2 * m4 - m3 * m3) - r1 * (m1 * m4 - m3 * m2) "
        "+ r2 * (m1 * m3 - m2 * m2)) / (m0 * (m2 * m4 - m3 * m3) - m1 * (m1 * m4 - m3 * m2) + m2 * (m1 * m3 - m2 * m2)), 3) "
        "AS y_fit FROM k")
    q["trend_line"] = lambda: rnd(with_(
        RATED, "base AS (SELECT CAST(points AS DOUBLE) AS x, price AS y, "
               "CAST(points AS DECIMAL(30, 2)) AS xd, CAST(price AS DECIMAL(30, 2)) AS yd FROM ri "
               "WHERE points IS NOT NULL AND price IS NOT NULL)",
        "m AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(xd) AS DOUBLE) AS sx, "
        "CAST(sum(yd) AS DOUBLE) AS sy, CAST(sum(xd * xd) AS DOUBLE) AS sxx, "
        "CAST(sum(xd * yd) AS DOUBLE) AS sxy, min(x) AS lo, max(x) AS hi FROM base)",
        "s AS (SELECT lo, hi, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS b, n, sx, sy FROM m)",
        "s2 AS (SELECT lo, hi, b, (sy - b * sx) / n AS a FROM s)",
        "bb AS (SELECT CAST(least(floor((x - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin, yd "
        "FROM base CROSS JOIN s2)",
        "g AS (SELECT bin, CAST(sum(yd) AS DOUBLE) / count(*) AS y_mean, count(*) AS n FROM bb GROUP BY bin)") +
        "SELECT g.bin, lo + (g.bin + 0.5) * ((hi - lo) / 20) AS x_mid, g.y_mean, "
        "a + b * (lo + (g.bin + 0.5) * ((hi - lo) / 20)) AS y_fit, g.n FROM g CROSS JOIN s2",
        "x_mid", "y_mean", "y_fit")
    q["shortest_hops"] = lambda: hops_ctes() + "SELECT r, c, hops FROM h"
    q["shortest_path"] = lambda: (hops_ctes() +
                          ", par AS (SELECT h.r, h.c, h.hops, min({'r': p.r, 'c': p.c}) AS pp FROM h "
                          "JOIN e ON e.r2 = h.r AND e.c2 = h.c JOIN h p ON p.r = e.r AND p.c = e.c "
                          "AND p.hops = h.hops - 1 GROUP BY h.r, h.c, h.hops)"
                          ", path(r, c, hops) AS (SELECT h.r, h.c, h.hops FROM h, goal WHERE h.r = goal.gr "
                          "AND h.c = goal.gc UNION ALL SELECT par.pp.r, par.pp.c, par.hops - 1 FROM path "
                          "JOIN par ON par.r = path.r AND par.c = path.c) "
                          "SELECT hops AS step, r, c FROM path")
    q["ascent_path"] = lambda: (hops_ctes() +
                        ", up AS (SELECT h.r, h.c, h.hops, first({'r': e.r2, 'c': e.c2} ORDER BY CASE e.dir "
                        "WHEN 'W' THEN 0 WHEN 'E' THEN 1 WHEN 'N' THEN 2 ELSE 3 END) AS pp FROM h "
                        "JOIN e ON e.r = h.r AND e.c = h.c JOIN h p ON p.r = e.r2 AND p.c = e.c2 "
                        "AND p.hops = h.hops - 1 GROUP BY h.r, h.c, h.hops)"
                        ", path(r, c, step) AS (SELECT gr, gc, 0 FROM goal UNION ALL SELECT up.pp.r, up.pp.c, "
                        "path.step + 1 FROM path JOIN up ON up.r = path.r AND up.c = path.c) "
                        "SELECT step, r, c FROM path")
    q["discounted_reach"] = lambda: rnd(
        hops_ctes() + ", gh AS (SELECT max(h.hops) AS ghops FROM h, goal WHERE h.r = goal.gr AND h.c = goal.gc) "
        "SELECT cells.r, cells.c, coalesce(CASE WHEN h.hops <= coalesce((SELECT ghops FROM gh), 2147483647) "
        "THEN power(0.99, h.hops) ELSE 0.0 END, 0.0) AS value FROM cells LEFT JOIN h "
        "ON cells.r = h.r AND cells.c = h.c", "value")
    graph = ("WITH RECURSIVE pr AS (SELECT DISTINCT 'c' || o_custkey AS a, 'p' || l_partkey AS b FROM orders "
             "JOIN lineitem ON o_orderkey = l_orderkey WHERE o_custkey IS NOT NULL AND l_partkey IS NOT NULL), "
             "e AS (SELECT a AS src, b AS dst FROM pr UNION ALL SELECT b, a FROM pr), "
             "go AS (SELECT min(a) AS start FROM pr), ")
    # a bound on the hops keeps the walk from going to and fro for ever; the graph is far narrower
    walk = ("{0}(node, hops) AS (SELECT {1}, 0 UNION SELECT e.dst, {0}.hops + 1 FROM {0} JOIN e ON e.src = {0}.node "
            "WHERE {0}.hops < 20), h{0} AS (SELECT node, CAST(min(hops) AS INTEGER) AS hops FROM {0} GROUP BY node), ")
    there = graph + walk.format("f", "(SELECT start FROM go)")
    q["edge_hops"] = lambda: (there + "par AS (SELECT x.node, min(e.src) AS parent FROM hf x JOIN e ON e.dst = x.node "
                      "JOIN hf y ON y.node = e.src AND y.hops = x.hops - 1 GROUP BY x.node) "
                      "SELECT node, hops, parent FROM hf LEFT JOIN par USING (node)")
    q["edge_path"] = lambda: (there + "goal AS (SELECT node, hops FROM hf ORDER BY hops DESC, node DESC LIMIT 1), "
                      + walk.format("b", "(SELECT node FROM goal)") +
                      "dag AS (SELECT hf.node, hf.hops FROM hf JOIN hb USING (node) "
                      "WHERE hf.hops + hb.hops = (SELECT hops FROM goal)), "
                      "nxt AS (SELECT x.node, min(y.node) AS to_ FROM dag x JOIN e ON e.src = x.node "
                      "JOIN dag y ON y.node = e.dst AND y.hops = x.hops + 1 GROUP BY x.node), "
                      "path(step, node) AS (SELECT 0, start FROM go UNION ALL SELECT step + 1, to_ FROM path "
                      "JOIN nxt ON nxt.node = path.node) SELECT CAST(step AS INTEGER) AS step, node FROM path")
    q["edge_reach"] = lambda: rnd(there + "one AS (SELECT 1) SELECT n.node, coalesce(power(0.99, hops), 0.0) AS value FROM "
                          "(SELECT DISTINCT src AS node FROM e) n LEFT JOIN hf USING (node)", "value")
    return q
