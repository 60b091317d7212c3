"""Reader policies decided when a view is read, from tables of memberships and rights.

A view made here is defined once for all readers. Who reads it, and what groups that reader is in, is
found at each read, so a membership or right that is added or taken away counts from the next read on.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from partledger.operators import policy

MEMBERSHIPS = "member string, group_name string"
RIGHTS = "group_name string, object_name string, right_name string"
# What a right may be: a column shown, all rows, or the rows that have a key.
ALL_ROWS, KEYED_ROWS = "rows:all", "rows:keyed"


def column_right(column: str) -> str:
    return f"column:{column}"


def standard_rights(spark: SparkSession, name: str, masked: Mapping[str, tuple[str, ...]]) -> DataFrame:
    """The rights that ``policy`` states in code, as rows for one object."""
    rows = [(g, name, column_right(c)) for c, groups in masked.items() for g in groups]
    rows += [(g, name, ALL_ROWS) for g in policy.ROW_READERS_ALL] + [(g, name, KEYED_ROWS) for g in policy.ROW_READERS_KEYED]
    return spark.createDataFrame(rows, RIGHTS)


def _name(text: str) -> str:
    return "`" + text.replace("`", "``") + "`"


def _text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def guarded_view(spark: SparkSession, view: str, table: str, key: str, masked: tuple[str, ...], memberships: str, rights: str,
                 reader: str = "current_user()") -> None:
    """Define ``view`` over ``table``: each reader gets the rows and the values of ``masked`` columns that its groups may see.

    All four are names of tables or views; ``reader`` is an SQL expression. Groups may be members of groups, to any depth and
    in circles. A reader in no group with a right to rows gets none; nulls in the two tables give no right. The reader's
    rights are one uncorrelated subquery, evaluated once before the scan, so the table is read as it would be without it.
    """
    allowed = f"""(SELECT collect_set(r.right_name) FROM {rights} r JOIN reach ON r.group_name = reach.group_name
               WHERE r.object_name = {_text(table)})"""
    columns = ", ".join(
        f"CASE WHEN array_contains({allowed}, {_text(column_right(c))}) THEN {_name(c)} END AS {_name(c)}" if c in masked else _name(c)
        for c in spark.table(table).columns)
    spark.sql(f"""
CREATE OR REPLACE TEMPORARY VIEW {view} AS
WITH RECURSIVE reach (group_name, path) AS (
  SELECT group_name, array(group_name) FROM {memberships} WHERE member = {reader}
  UNION ALL
  SELECT m.group_name, array_append(reach.path, m.group_name)
  FROM {memberships} m JOIN reach ON m.member = reach.group_name WHERE NOT array_contains(reach.path, m.group_name))
SELECT {columns} FROM {table}
WHERE array_contains({allowed}, '{ALL_ROWS}') OR ({_name(key)} IS NOT NULL AND array_contains({allowed}, '{KEYED_ROWS}'))""")
