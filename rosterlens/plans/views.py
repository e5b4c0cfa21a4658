"""The nine reporting views as SQL, for a database of its own tables."""

from __future__ import annotations

from rosterlens.schema import SMALLINT_COLUMNS, VIEW_NAMES

_STATS = [c for c in SMALLINT_COLUMNS if c not in ("total_level", "hp")]
_LOW = "least(" + ", ".join(f"`{c}`" for c in _STATS) + ")"


def _stacked(condition: str, name: str) -> str:
    counts = ", ".join(f"count_if({condition.format(c=c)}) AS `{c}`" for c in _STATS)
    cells = ", ".join(f"struct('{c}' AS stat_name, `{c}` AS {name})" for c in _STATS)
    return f"SELECT * FROM (SELECT inline(array({cells})) FROM (SELECT {counts} FROM {{db}}.character)) WHERE {name} > 0"


_SQL = [
    "SELECT class, count(DISTINCT char_id) AS character_count FROM {db}.character_class GROUP BY class",
    "SELECT race, count(1) AS character_count FROM {db}.character WHERE race IS NOT NULL AND race <> '' GROUP BY race",
    "SELECT count_if(n > 1) AS multiclass_characters FROM "
    "(SELECT char_id, count(1) AS n FROM {db}.character_class GROUP BY char_id)",
    "SELECT count_if(total_level = 20) AS level_20_characters FROM {db}.character",
    _stacked("`{c}` >= 20", "maxed_count"),
    _stacked("`{c}` = " + _LOW, "dump_count"),
    # R7 as in operators.aggregates.group_summary; a character has one notes length, so the rows of
    # (class, character) are the characters
    "SELECT class, sum(n) AS characters, sum(w * notes_len) / sum(w) AS avg_notes_len, "
    "(max(CASE WHEN upto > (total - 1) div 2 AND upto - w <= (total - 1) div 2 THEN notes_len END) "
    "+ max(CASE WHEN upto > total div 2 AND upto - w <= total div 2 THEN notes_len END)) / 2 AS median_notes_len FROM ("
    "SELECT class, notes_len, n, w, sum(w) OVER (PARTITION BY class ORDER BY notes_len ROWS UNBOUNDED PRECEDING) AS upto, "
    "sum(w) OVER (PARTITION BY class) AS total FROM ("
    "SELECT class, notes_len, count(1) AS n, sum(w) AS w FROM ("
    "SELECT k.char_id, class, notes_len, count(1) AS w FROM {db}.character_class k JOIN {db}.character c ON c.char_id = k.char_id "
    "WHERE notes_len IS NOT NULL GROUP BY k.char_id, class, notes_len) GROUP BY class, notes_len)) GROUP BY class",
    "SELECT class, subclass AS most_popular_subclass, n AS subclass_count FROM (SELECT class, subclass, n, "
    "row_number() OVER (PARTITION BY class ORDER BY n DESC, subclass) AS rn FROM (SELECT class, subclass, count(1) AS n "
    "FROM {db}.character_class WHERE subclass IS NOT NULL AND subclass <> '' GROUP BY class, subclass)) WHERE rn = 1",
    "SELECT count(1) AS total_characters, (SELECT multiclass_characters FROM {db}.vw_multiclass_count) AS multiclass_characters, "
    "(SELECT level_20_characters FROM {db}.vw_level_20_count) AS level_20_characters, avg(total_level) AS avg_total_level "
    "FROM {db}.character",
]
VIEWS = dict(zip(VIEW_NAMES, _SQL))
