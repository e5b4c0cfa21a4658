"""DuckDB SQL for every registered query, over the pre-registered parquet
views (orders, customer, lineitem, part, ...).

Written independently of the Spark code: plain SQL CTEs that restate the
reference's semantics (the fixture adapter of FIXTURES.md section 4, then
cleaning, modelling, keys and reports).
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixed values
# White space removed by Python's str.strip(), as code points.
_WS_CODES = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760,
             8192, 8193, 8194, 8195, 8196, 8197, 8198, 8199, 8200, 8201, 8202,
             8232, 8233, 8239, 8287, 12288]
_STATS = [("str", "stats_1"), ("dex", "stats_2"), ("con", "stats_3"),
          ("int", "stats_4"), ("wis", "stats_5"), ("cha", "stats_6")]
_CORR = ["total_level", "hp", "str", "dex", "con", "int", "wis", "cha", "notes_len"]
_EXCLUDED = "promo|small"
# pandas read_csv default NA tokens.
_NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
              "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
_RAW_COLUMNS = ["char_id", "name", "race", "background", "total_level", "base_hp", "stats_1", "stats_2",
                "stats_3", "stats_4", "stats_5", "stats_6", "notes_len", "date_modified", "class_starting",
                "subclass_starting", "class_starting_level", "class_other", "subclass_other", "feats"]
# ------------------------------------------------------------ end fixed values

_WS = "(" + "||".join(f"chr({c})" for c in _WS_CODES) + ")"


def _strip(e: str) -> str:
    return f"trim({e}, {_WS})"


def _norm(e: str) -> str:
    s = _strip(e)
    return f"(CASE WHEN {s} IN ('', 'nan', 'None') THEN NULL ELSE {s} END)"


def _split(e: str) -> str:
    return (f"coalesce(list_filter(list_transform(string_split({e}, '/'), lambda x: {_strip('x')}), "
            f"lambda x: x <> '' AND lower(x) NOT IN ('nan', 'none')), [])")


def _num(e: str, lo=None, hi=None) -> str:
    n = f"try_cast({e} AS DOUBLE)"
    if lo is not None and hi is not None:
        return f"(CASE WHEN {n} BETWEEN {lo} AND {hi} THEN {n} END)"
    if lo is not None:
        return f"(CASE WHEN {n} >= {lo} THEN {n} END)"
    return n


ADAPTER = """
line AS (
  select l_orderkey as k, l_partkey as pk, row_number() over (
    partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) as ln
  from lineitem
), wide AS (
  select k,
    max(case when ln = 1 then p_type end) as c1, max(case when ln = 1 then p_brand end) as s1,
    max(case when ln = 2 then p_type end) as c2, max(case when ln = 3 then p_type end) as c3,
    string_agg(p_type, '/' order by ln) filter (ln >= 4) as c4,
    string_agg(p_brand, '/' order by ln) filter (ln >= 2) as s2,
    string_agg(p_name, ' / ' order by ln) as f
  from line join part on p_partkey = pk group by k
), base AS (
  select o_orderkey as k, o_orderdate as d, o_orderpriority as background, c_name, c_mktsegment, w.*
  from orders join customer on c_custkey = o_custkey
  left join (select k as wk, c1, s1, c2, c3, c4, s2, f from wide) w on w.wk = o_orderkey
), versions AS (
  select base.*, 0 as v, cast(d as string) as ds from base
  union all
  select base.*, 1 as v,
    case when k % 20 = 0 then 'garbage' when k % 30 = 0 then cast(d as string)
         else cast(d + interval '1' day as string) end as ds
  from base where k % 10 = 0
), raw AS MATERIALIZED (
select
  v as src_ord,
  cast(k as string) as char_id,
  case when k % 37 = 0 or (v = 1 and k % 70 = 0) then c_name || chr(39) || 's Character'
       when k % 41 = 0 then '   ' when k % 43 = 0 then 'nan' when k % 47 = 0 then null
       when k % 53 = 0 then '  ' || c_name || chr(9) else c_name end as name,
  case when k % 59 = 0 then null else c_mktsegment end as race,
  background,
  case when k % 67 = 0 then 'unknown' else cast((k + v) % 23 as string) end as total_level,
  cast(k % 200 - 10 as string) as base_hp,
  cast((k * 7 + 1) % 33 as string) as stats_1,
  cast((k * 11 + 2) % 33 as string) as stats_2,
  cast((k * 13 + 3) % 33 as string) as stats_3,
  cast((k * 17 + 4) % 33 as string) as stats_4,
  case when k % 29 = 0 then null else cast((k * 19 + 5) % 33 as string) end as stats_5,
  cast((k * 23 + 6) % 33 as string) as stats_6,
  case when k % 11 = 0 then null else cast((k * 13) % 5000 - 50 as string) end as notes_len,
  ds as date_modified,
  c1 as class_starting,
  case when k % 31 = 0 then ' None ' else s1 end as subclass_starting,
  cast(k % 22 as string) as class_starting_level,
  nullif(concat_ws('/', c2, ' ' || c3 || ' ', case when k % 13 = 0 then 'NONE' end, '', c4), '') as class_other,
  nullif(concat_ws('/', s2, case when k % 23 = 0 then 'Extra/More' end), '') as subclass_other,
  nullif(f, '') as feats
from versions
)"""

_NUMERIC_RULES = {
    "total_level": (1, 20), "class_starting_level": (1, 20), "base_hp": (0, None), "notes_len": (0, None),
    **{f"stats_{i}": (1, 30) for i in range(1, 7)},
}

PIPELINE = f"""
named AS (
  SELECT * REPLACE ({_norm('name')} AS name) FROM raw
), valid AS (
  SELECT * FROM named
  WHERE name IS NOT NULL AND NOT regexp_matches(name, '[''’]s character', 'i')
), dated AS (
  SELECT * REPLACE (try_cast(date_modified AS TIMESTAMP) AS date_modified) FROM valid
), latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY char_id ORDER BY date_modified DESC NULLS FIRST, src_ord DESC) AS rn
    FROM dated) WHERE rn = 1
), clean AS MATERIALIZED (
  SELECT * REPLACE ({', '.join(f"{_num(c, *b)} AS {c}" for c, b in _NUMERIC_RULES.items())}) FROM latest
), lists AS (
  SELECT char_id AS source_id, {_split('class_other')} AS cls, {_split('subclass_other')} AS sub,
         {_split('feats')} AS fl
  FROM clean
), class_all AS (
  SELECT char_id AS source_id, {_norm('class_starting')} AS class, {_norm('subclass_starting')} AS subclass,
         CAST(class_starting_level AS SMALLINT) AS level, 0 AS ord
  FROM clean
  UNION ALL
  SELECT source_id, {_norm('cls[i]')}, {_norm('sub[i]')}, CAST(NULL AS SMALLINT), i
  FROM (SELECT source_id, cls, sub, generate_subscripts(cls, 1) AS i FROM lists)
), class_u AS MATERIALIZED (
  SELECT source_id, class, subclass, level, ord FROM (
    SELECT *, row_number() OVER (PARTITION BY source_id, class, subclass ORDER BY ord) AS rn
    FROM class_all WHERE class IS NOT NULL) WHERE rn = 1
), feat_all AS (
  SELECT source_id, {_norm('fl[i]')} AS feat, i AS ord
  FROM (SELECT source_id, fl, generate_subscripts(fl, 1) AS i FROM lists)
), feat_u AS MATERIALIZED (
  SELECT source_id, feat, ord FROM (
    SELECT *, row_number() OVER (PARTITION BY source_id, feat ORDER BY ord) AS rn
    FROM feat_all WHERE feat IS NOT NULL) WHERE rn = 1
), multi AS (
  SELECT source_id FROM class_u GROUP BY source_id HAVING count(*) > 1
), character_u AS MATERIALIZED (
  SELECT char_id AS source_id, name, race, background,
    CAST(total_level AS SMALLINT) AS total_level, CAST(base_hp AS SMALLINT) AS hp,
    {', '.join(f"CAST({raw} AS SMALLINT) AS {st}" for st, raw in _STATS)},
    CAST(notes_len AS INTEGER) AS notes_len, date_modified AS recorded_at,
    char_id IN (SELECT source_id FROM multi) AS is_multiclass
  FROM clean
), character_k AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY try_cast(source_id AS DECIMAL(38,0)) NULLS LAST, source_id) AS char_id, *
  FROM character_u
), class_k AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY (c.ord > 0), k.char_id, c.ord) AS class_id,
         k.char_id, c.class, c.subclass, c.level
  FROM class_u c JOIN character_k k USING (source_id)
), feat_k AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY k.char_id, f.ord) AS feat_id, k.char_id, f.feat
  FROM feat_u f JOIN character_k k USING (source_id)
)"""

REPORTS = """
r_class_popularity AS (
  SELECT class, count(DISTINCT char_id) AS character_count FROM class_k GROUP BY class
), r_race_popularity AS (
  SELECT race, count(*) AS character_count FROM character_k
  WHERE race IS NOT NULL AND race <> '' GROUP BY race
), r_stats AS (
  UNPIVOT (SELECT char_id, str, dex, con, "int", wis, cha FROM character_k)
  ON str, dex, con, "int", wis, cha INTO NAME stat_name VALUE stat_value
), r_maxed_stats AS (
  SELECT stat_name, count(*) AS maxed_count FROM r_stats WHERE stat_value >= 20 GROUP BY stat_name
), r_dump_stats AS (
  SELECT s.stat_name, count(*) AS dump_count
  FROM r_stats s JOIN (SELECT char_id, least(str, dex, con, "int", wis, cha) AS lowest FROM character_k) m
    ON m.char_id = s.char_id AND s.stat_value = m.lowest
  GROUP BY s.stat_name
), r_class_notes_summary AS (
  SELECT cc.class, count(DISTINCT c.char_id) AS characters, avg(c.notes_len) AS avg_notes_len,
         quantile_cont(c.notes_len, 0.5) AS median_notes_len
  FROM character_k c JOIN class_k cc ON cc.char_id = c.char_id
  WHERE c.notes_len IS NOT NULL GROUP BY cc.class
), r_top_subclass_per_class AS (
  SELECT class, first(subclass ORDER BY subclass_count DESC, subclass) AS most_popular_subclass,
         max(subclass_count) AS subclass_count
  FROM (SELECT class, subclass, count(*) AS subclass_count FROM class_k
        WHERE subclass IS NOT NULL AND subclass <> '' GROUP BY class, subclass)
  GROUP BY class
), r_multiclass_rate AS (
  SELECT class, count(*) AS characters_with_class,
         count(*) FILTER (WHERE n_classes > 1) AS multiclass_characters,
         CAST((20000 * count(*) FILTER (WHERE n_classes > 1) + count(*)) // (2 * count(*)) AS DOUBLE) / 100
           AS multiclass_rate_pct
  FROM (SELECT DISTINCT char_id, class FROM class_k) m
  JOIN (SELECT char_id, count(DISTINCT class) AS n_classes FROM class_k GROUP BY char_id) n USING (char_id)
  GROUP BY class
), r_multiclass_count AS (
  SELECT count(*) AS multiclass_characters FROM (SELECT char_id FROM class_k GROUP BY char_id HAVING count(*) > 1)
), r_level_20 AS (
  SELECT count(*) AS level_20_characters FROM character_k WHERE total_level = 20
), r_explorer AS (
  SELECT 'class_popularity' AS metric, class AS category, CAST(character_count AS DOUBLE) AS count FROM r_class_popularity
  UNION ALL SELECT 'race_popularity', race, character_count FROM r_race_popularity
  UNION ALL SELECT 'notes_sample_size_by_class', class, characters FROM r_class_notes_summary
  UNION ALL SELECT 'avg_notes_len_by_class', class, avg_notes_len FROM r_class_notes_summary
  UNION ALL SELECT 'multiclass_characters_by_class', class, multiclass_characters FROM r_multiclass_rate
  UNION ALL SELECT 'characters_with_class', class, characters_with_class FROM r_multiclass_rate
  UNION ALL SELECT 'maxed_stat_count', stat_name, maxed_count FROM r_maxed_stats
  UNION ALL SELECT 'dump_stat_count', stat_name, dump_count FROM r_dump_stats
  UNION ALL SELECT 'top_subclass_count', class, subclass_count FROM r_top_subclass_per_class
)"""


def _with(body: str) -> str:
    return f"WITH {ADAPTER},\n{PIPELINE},\n{REPORTS}\n{body}"


def _split_lists() -> str:
    parts = []
    for field, col in (("class_other", "cls"), ("subclass_other", "sub"), ("feats", "fl")):
        parts.append(f"SELECT source_id, '{field}' AS field, CAST(i - 1 AS INTEGER) AS pos, {col}[i] AS item "
                     f"FROM (SELECT source_id, {col}, generate_subscripts({col}, 1) AS i FROM lists)")
    return " UNION ALL ".join(parts)


def _corr() -> str:
    cells = []
    for x in _CORR:
        for y in _CORR:
            qx, qy = f'"{x}"', f'"{y}"'
            if x == y:
                val = f"var_pop({qx}) / nullif(var_pop({qx}), 0)"
            else:
                val = (f"covar_pop({qx}, {qy}) / nullif(stddev_pop(CASE WHEN {qy} IS NOT NULL THEN {qx} END) * "
                       f"stddev_pop(CASE WHEN {qx} IS NOT NULL THEN {qy} END), 0)")
            # "+ 0.0" turns a rounded -0.0 into 0.0: equal values, one spelling.
            cells.append(f"SELECT '{x}' AS field_x, '{y}' AS field_y, round_even({val}, 2) + 0.0 AS corr "
                         "FROM character_k")
    return " UNION ALL ".join(cells)


def _checks() -> str:
    def nulls(rel, table, col):
        return (f"SELECT '{rel}' AS relation, 'not_null:{col}' AS check_name, "
                f"CAST(count(*) FILTER (WHERE {col} IS NULL) AS BIGINT) AS violations FROM {table}")

    def dups(rel, table, col):
        return (f"SELECT '{rel}', 'unique:{col}', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM "
                f"(SELECT {col}, count(*) AS n FROM {table} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1)")

    def orphans(rel, table):
        return (f"SELECT '{rel}', 'foreign_key:char_id', count(*) FROM {table} t "
                f"WHERE t.char_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM character_k c WHERE c.char_id = t.char_id)")

    parts = [
        nulls("character", "character_k", "char_id"), dups("character", "character_k", "char_id"),
        nulls("character_class", "class_k", "class_id"), dups("character_class", "class_k", "class_id"),
        nulls("character_class", "class_k", "char_id"), nulls("character_class", "class_k", "class"),
        orphans("character_class", "class_k"),
        nulls("character_feats", "feat_k", "feat_id"), dups("character_feats", "feat_k", "feat_id"),
        nulls("character_feats", "feat_k", "char_id"), nulls("character_feats", "feat_k", "feat"),
        orphans("character_feats", "feat_k"),
    ]
    return " UNION ALL ".join(parts)


_TS = "strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}"
_NA_LIST = ", ".join("'" + t.replace("'", "''") + "'" for t in _NA_TOKENS)
_CSV_COLS = ", ".join(f"CASE WHEN {c} IN ({_NA_LIST}) THEN NULL ELSE {c} END AS {c}" for c in _RAW_COLUMNS)
_CHAR_COLS = ("source_id, name, race, background, total_level, hp, str, dex, con, \"int\", wis, cha, notes_len, "
              + _TS.format(c="recorded_at") + ", is_multiclass")
_EXCL = f"NOT coalesce(regexp_matches(class, '{_EXCLUDED}', 'i'), false)"

def _views() -> str:
    """Every number of the nine views: (view, category, field, value)."""
    fields = [
        ("vw_class_popularity", "r_class_popularity", "class", ["character_count"]),
        ("vw_race_popularity", "r_race_popularity", "race", ["character_count"]),
        ("vw_multiclass_count", "(SELECT count(*) AS multiclass_characters FROM "
         "(SELECT char_id FROM class_k GROUP BY char_id HAVING count(*) > 1))", None, ["multiclass_characters"]),
        ("vw_level_20_count", "(SELECT count(*) AS level_20_characters FROM character_k WHERE total_level = 20)", None,
         ["level_20_characters"]),
        ("vw_maxed_stats", "r_maxed_stats", "stat_name", ["maxed_count"]),
        ("vw_dump_stats", "r_dump_stats", "stat_name", ["dump_count"]),
        ("vw_class_notes_summary", "r_class_notes_summary", "class", ["characters", "avg_notes_len", "median_notes_len"]),
        ("vw_top_subclass_per_class", "r_top_subclass_per_class", "class", ["subclass_count"]),
        ("vw_dashboard_kpis", "(SELECT count(*) AS total_characters, (SELECT count(*) FROM (SELECT char_id FROM class_k "
         "GROUP BY char_id HAVING count(*) > 1)) AS multiclass_characters, count(*) FILTER (WHERE total_level = 20) "
         "AS level_20_characters, avg(total_level) AS avg_total_level FROM character_k)", None,
         ["total_characters", "multiclass_characters", "level_20_characters", "avg_total_level"]),
    ]
    return " UNION ALL ".join(
        f"SELECT '{view}' AS \"view\", {label or repr(c)} AS category, '{c}' AS field, round(CAST({c} AS DOUBLE), 6) AS value "
        f"FROM {table}" for view, table, label, cs in fields for c in cs)


ORACLE: dict[str, str] = {
    "clean_profiles": _with("SELECT * REPLACE (CAST(src_ord AS BIGINT) AS src_ord, "
                            + _TS.format(c="date_modified") + ") FROM clean"),
    "normalize_names": _with("SELECT char_id, CAST(src_ord AS BIGINT) AS src_ord, name FROM valid"),
    "latest_versions": _with("SELECT char_id, CAST(src_ord AS BIGINT) AS src_ord, "
                             + _TS.format(c="date_modified") + ", name FROM latest"),
    "first_versions": _with("SELECT char_id, CAST(src_ord AS BIGINT) AS src_ord, name FROM ("
                            "SELECT *, row_number() OVER (PARTITION BY char_id ORDER BY src_ord) AS rn FROM valid) "
                            "WHERE rn = 1"),
    "bounded_numerics": _with("SELECT char_id, CAST(src_ord AS BIGINT) AS src_ord, "
                              + ", ".join(f"{_num(c, *b)} AS {c}" for c, b in _NUMERIC_RULES.items())
                              + " FROM raw"),
    "characters": _with(f"SELECT {_CHAR_COLS} FROM character_u"),
    "split_lists": _with(_split_lists()),
    "class_rows": _with("SELECT source_id, class, subclass, level FROM class_u"),
    "feat_rows": _with("SELECT source_id, feat FROM feat_u"),
    "keyed_characters": _with(f"SELECT char_id, {_CHAR_COLS} FROM character_k"),
    "key_map": _with("SELECT source_id, char_id FROM character_k"),
    "keyed_classes": _with("SELECT c.source_id, c.class, c.subclass, c.level, k.char_id "
                           "FROM class_u c JOIN character_k k USING (source_id)"),
    "keyed_feats": _with("SELECT f.source_id, f.feat, k.char_id FROM feat_u f JOIN character_k k USING (source_id)"),
    "class_keys": _with("SELECT class_id, char_id, class, subclass, level FROM class_k"),
    "feat_keys": _with("SELECT feat_id, char_id, feat FROM feat_k"),
    "relation_counts": _with("SELECT 'character' AS relation, count(*) AS \"rows\" FROM character_k "
                             "UNION ALL SELECT 'character_class', count(*) FROM class_k "
                             "UNION ALL SELECT 'character_feats', count(*) FROM feat_k"),
    "refresh_counts": _with("SELECT 'character' AS relation, count(*) AS \"rows\" FROM character_k "
                            "UNION ALL SELECT 'character_class', count(*) FROM class_k "
                            "UNION ALL SELECT 'character_feats', count(*) FROM feat_k"),
    "refreshed_character": _with(f"SELECT * EXCLUDE (is_multiclass) FROM (SELECT char_id, {_CHAR_COLS} FROM character_k)"),
    "refreshed_classes": _with("SELECT class_id, char_id, class, subclass, level FROM class_k"),
    "refreshed_feats": _with("SELECT feat_id, char_id, feat FROM feat_k"),
    "refreshed_views": _with(_views()),
    "orphan_check": _with(_checks()),
    "cascade_delete": _with(" UNION ALL ".join(
        f"SELECT '{name}' AS relation, {key} AS row_id, char_id, {item} AS item FROM {table} WHERE char_id NOT IN "
        "(SELECT char_id FROM character_k WHERE recorded_at IS NULL)" for name, table, key, item in (
            ("character", "character_k", "char_id", "source_id"), ("character_class", "class_k", "class_id", "class"),
            ("character_feats", "feat_k", "feat_id", "feat")))),
    "numeric_projection": _with("SELECT total_level, hp, str, dex, con, \"int\" AS int_stat, wis, cha, notes_len "
                                "FROM character_k"),
    "sample_rows": _with("SELECT * REPLACE (CAST(src_ord AS BIGINT) AS src_ord) FROM raw "
                         "ORDER BY src_ord, try_cast(char_id AS DECIMAL(38,0)) NULLS LAST, char_id LIMIT 1000"),
    "view_lookup": _with("SELECT * FROM r_top_subclass_per_class"),
    "csv_landing": _with(f"SELECT {_CSV_COLS} FROM raw"),
    "class_popularity": _with("SELECT * FROM r_class_popularity ORDER BY character_count DESC"),
    "race_popularity": _with("SELECT * FROM r_race_popularity ORDER BY character_count DESC"),
    "multiclass_count": _with("SELECT * FROM r_multiclass_count"),
    "level_20_count": _with("SELECT * FROM r_level_20"),
    "maxed_stats": _with("SELECT * FROM r_maxed_stats"),
    "dump_stats": _with("SELECT * FROM r_dump_stats"),
    "class_notes_summary": _with("SELECT * FROM r_class_notes_summary ORDER BY avg_notes_len DESC"),
    "top_subclass_per_class": _with("SELECT * FROM r_top_subclass_per_class ORDER BY class"),
    "multiclass_rate_by_class": _with("SELECT * FROM r_multiclass_rate "
                                      "ORDER BY multiclass_rate_pct DESC, characters_with_class DESC"),
    "dashboard_kpis": _with("SELECT count(*) AS total_characters, "
                            "(SELECT count(*) FROM (SELECT char_id FROM class_k GROUP BY char_id HAVING count(*) > 1)) AS multiclass_characters, "
                            "count(*) FILTER (WHERE total_level = 20) AS level_20_characters, "
                            "avg(total_level) AS avg_total_level FROM character_k"),
    "top_classes": _with("SELECT * FROM r_class_popularity ORDER BY character_count DESC, class LIMIT 15"),
    "top_races": _with("SELECT * FROM r_race_popularity ORDER BY character_count DESC, race LIMIT 15"),
    "maxed_sorted": _with("SELECT * FROM r_maxed_stats ORDER BY maxed_count DESC"),
    "dump_sorted": _with("SELECT * FROM r_dump_stats ORDER BY dump_count DESC"),
    "top_subclasses": _with("SELECT * FROM r_top_subclass_per_class ORDER BY subclass_count DESC, class LIMIT 20"),
    "notes_filtered": _with(f"SELECT * FROM r_class_notes_summary WHERE {_EXCL} ORDER BY avg_notes_len DESC"),
    "multiclass_filtered": _with(f"SELECT * FROM r_multiclass_rate WHERE {_EXCL} "
                                 "ORDER BY multiclass_rate_pct DESC, characters_with_class DESC"),
    "explorer_union": _with("SELECT * FROM r_explorer"),
    "explorer_page": _with("SELECT * FROM r_explorer WHERE metric <> 'avg_notes_len_by_class' "
                           "ORDER BY count DESC, metric, category LIMIT 20 OFFSET 20"),
    "correlation_matrix": _with(_corr()),
    "kpi_cards": _with("SELECT * FROM (VALUES "
                       "('Total Characters', (SELECT format('{:,}', count(*)) FROM character_k)), "
                       "('Multiclass Characters', (SELECT format('{:,}', multiclass_characters) FROM r_multiclass_count)), "
                       "('Level 20 Characters', (SELECT format('{:,}', level_20_characters) FROM r_level_20)), "
                       "('Average Level', (SELECT printf('%.2f', avg(total_level)) FROM character_k))"
                       ") AS t(title, value)"),
}
