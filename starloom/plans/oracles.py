"""SQL counterparts of the queries, for DuckDB.

They follow the definitions the plain way: every rectangle of the uniform grid is tested,
the quadtree is descended level by level, cells are merged one step at a time.
"""

from __future__ import annotations

from starloom.plans import settings as S

POINTS = """
points AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS x, l_quantity AS y FROM lineitem
)"""
VECTORS = """
points AS (
  SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings
)"""
EVENTS = """
points AS (SELECT event_id, value AS x, CAST(user_id AS DOUBLE) AS y FROM events)"""
BOX = """
box AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM points)"""
POINT_COLUMNS = "l_orderkey, l_linenumber, l_partkey, x, y"
VECTOR_COLUMNS = "vec_id, x, y"
EVENT_COLUMNS = "event_id, x, y"


def _with(*parts: str) -> str:
    return "WITH RECURSIVE " + ",".join(parts) + "\n"


def _uniform(n: int, columns: str = POINT_COLUMNS) -> str:
    """Every row against every closed rectangle; the first one in scan order holds it."""
    separator = "" if n <= 10 else "_"
    return f"""
grid AS (
  SELECT i, j, CAST(i AS VARCHAR) || '{separator}' || CAST(j AS VARCHAR) AS cell,
         x0 + i * ((x1 - x0) / {n}) AS a, x0 + (i + 1) * ((x1 - x0) / {n}) AS b,
         y0 + j * ((y1 - y0) / {n}) AS c, y0 + (j + 1) * ((y1 - y0) / {n}) AS d, x1, y1
  FROM box, range({n}) AS r(i), range({n}) AS s(j)
),
numbered AS (SELECT *, row_number() OVER () AS rid FROM points),
held AS (
  SELECT rid, arg_min(cell, i * {n} + j) AS cell
  FROM numbered JOIN grid
    ON x >= a AND x <= CASE WHEN i = {n} - 1 THEN greatest(b, x1) ELSE b END
   AND y >= c AND y <= CASE WHEN j = {n} - 1 THEN greatest(d, y1) ELSE d END
  GROUP BY rid
),
tagged AS (SELECT {columns}, coalesce(held.cell, '-1') AS cell FROM numbered LEFT JOIN held USING (rid))"""


def _levels(depth: int, columns: str) -> str:
    """Level by level: the cell of each row and the rectangle of that cell."""
    parts = [f"""
level0 AS MATERIALIZED (
  SELECT {columns}, x0 AS a, x1 AS b, y0 AS c, y1 AS d, '_' AS cell FROM points, box
)"""]
    for k in range(depth):
        parts.append(f"""
half{k} AS (
  SELECT *, (a + b) / 2 AS mx, (c + d) / 2 AS my,
         CASE WHEN x <= (a + b) / 2 AND y <= (c + d) / 2 THEN 0
              WHEN x >= (a + b) / 2 AND y <= (c + d) / 2 THEN 1
              WHEN x >= (a + b) / 2 AND y >= (c + d) / 2 THEN 2 ELSE 3 END AS q
  FROM level{k}
),
level{k + 1} AS MATERIALIZED (
  SELECT {columns},
         CASE WHEN q IN (0, 3) THEN a ELSE mx END AS a, CASE WHEN q IN (0, 3) THEN mx ELSE b END AS b,
         CASE WHEN q IN (0, 1) THEN c ELSE my END AS c, CASE WHEN q IN (0, 1) THEN my ELSE d END AS d,
         cell || CAST(q AS VARCHAR) AS cell
  FROM half{k}
)""")
    union = "\n  UNION ALL ".join(
        f"SELECT {k} AS depth, cell, count(*) AS n, min(a) AS x0, min(b) AS x1, min(c) AS y0, min(d) AS y1"
        f" FROM level{k} GROUP BY cell"
        for k in range(depth + 1)
    )
    parts.append(f"""
cells AS MATERIALIZED (
  {union}
)""")
    return ",".join(parts)


def _tree(
    threshold: int | str,
    columns: str = POINT_COLUMNS,
    max_heavy: int | None = None,
    depth: int = S.MAX_DEPTH,
) -> str:
    """Leaves: cells that a round reached and no round split."""
    heavy = f"""
heavy AS (SELECT depth, count(*) FILTER (n > {threshold}) AS heavy FROM cells GROUP BY depth),
halt AS (SELECT coalesce(min(depth), {depth}) AS stop FROM heavy
         WHERE {'false' if max_heavy is None else f'heavy > {max_heavy}'})"""
    leaves = f"""
leaves AS MATERIALIZED (
  SELECT cells.* FROM cells CROSS JOIN halt
  LEFT JOIN cells AS parent ON parent.cell = left(cells.cell, length(cells.cell) - 1)
  WHERE (cells.depth = 0 OR parent.n > {threshold})
    AND (cells.n <= {threshold} OR cells.depth = stop) AND cells.depth <= stop
),
assigned AS (
  SELECT {', '.join('p.' + c.strip() for c in columns.split(','))}, leaves.cell
  FROM level{depth} AS p JOIN leaves ON starts_with(p.cell, leaves.cell)
)"""
    return ",".join([_levels(depth, columns), heavy, leaves])


def _merge(minimum: int) -> str:
    """One leaf per step: close the open group, give it to the left, or let it grow."""
    return f"""
ordered AS MATERIALIZED (SELECT cell, n, row_number() OVER (ORDER BY cell) AS i FROM leaves),
walk AS (
  SELECT i, CAST(NULL AS BIGINT) AS left_n, CAST(NULL AS VARCHAR) AS left_head,
         n AS open_n, [cell] AS open, CAST(NULL AS VARCHAR[]) AS out, CAST(NULL AS VARCHAR) AS out_head
  FROM ordered WHERE i = 1
  UNION ALL
  SELECT o.i,
         CASE WHEN open_n >= {minimum} THEN open_n WHEN left_n < o.n THEN left_n + open_n ELSE left_n END,
         CASE WHEN open_n >= {minimum} THEN open[1] ELSE left_head END,
         CASE WHEN open_n >= {minimum} OR left_n < o.n THEN o.n ELSE open_n + o.n END,
         CASE WHEN open_n >= {minimum} OR left_n < o.n THEN [o.cell] ELSE list_append(open, o.cell) END,
         CASE WHEN open_n >= {minimum} OR left_n < o.n THEN open END,
         CASE WHEN open_n >= {minimum} THEN open[1] WHEN left_n < o.n THEN left_head END
  FROM walk JOIN ordered AS o ON o.i = walk.i + 1
),
settled AS (
  SELECT unnest(out) AS cell, out_head AS head FROM walk WHERE out IS NOT NULL
  UNION ALL
  SELECT unnest(open), CASE WHEN open_n < {minimum} AND left_n IS NOT NULL THEN left_head ELSE open[1] END
  FROM walk WHERE i = (SELECT max(i) FROM ordered)
),
names AS (
  SELECT head, string_agg(cell, '' ORDER BY cell) AS id_part, CAST(sum(n) AS BIGINT) AS group_n
  FROM settled JOIN leaves USING (cell) GROUP BY head
),
groups AS MATERIALIZED (
  SELECT id_part, cell, n, group_n FROM settled JOIN leaves USING (cell) JOIN names USING (head)
)"""


def _ranges() -> str:
    """Narrow the root box once per character of each member."""
    return """
ids AS (SELECT DISTINCT id_part FROM groups),
members AS (
  SELECT id_part, CAST(generate_subscripts(paths, 1) - 1 AS INTEGER) AS pos, unnest(paths) AS path
  FROM (SELECT id_part, string_split(substr(id_part, 2), '_') AS paths FROM ids)
),
narrowed AS (
  SELECT id_part, pos, path, 1 AS step, x0, x1, y0, y1 FROM members, box
  UNION ALL
  SELECT id_part, pos, path, step + 1,
         CASE WHEN path[step] IN ('0', '3') THEN x0 ELSE (x0 + x1) / 2 END,
         CASE WHEN path[step] IN ('0', '3') THEN (x0 + x1) / 2 ELSE x1 END,
         CASE WHEN path[step] IN ('0', '1') THEN y0 ELSE (y0 + y1) / 2 END,
         CASE WHEN path[step] IN ('0', '1') THEN (y0 + y1) / 2 ELSE y1 END
  FROM narrowed WHERE step <= length(path)
),
ranges AS (
  SELECT id_part, pos, '_' || path AS member, x0, x1, y0, y1 FROM narrowed WHERE step = length(path) + 1
)"""


LINEITEM_COLUMNS = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate"
).split()


def _line(columns: list[str]) -> str:
    return " || ',' || ".join(f"coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in columns)


LINE = _line(LINEITEM_COLUMNS)
POINT_LINE = _line([c.strip() for c in POINT_COLUMNS.split(",")])


def _pages() -> str:
    return f"""
copies AS (SELECT cell, {POINT_LINE} AS line, count(*) AS copies FROM tagged GROUP BY ALL),
sizes AS (SELECT cell, CAST(ceil(count(*) / {S.PAGE_ROWS}) AS BIGINT) AS pages FROM tagged GROUP BY cell),
placed AS (
  SELECT cell, line, CAST('0x' || left(md5(line), 8) AS BIGINT) % pages AS page,
         CAST(unnest(range(0, (copies - 1) // {S.PAGE_ROWS} + 1)) AS INTEGER) AS piece, copies
  FROM copies JOIN sizes USING (cell)
),
repeated AS (
  SELECT cell, page, piece, line,
         unnest(range(least({S.PAGE_ROWS}, copies - piece * {S.PAGE_ROWS}))) AS copy
  FROM placed
)"""


def _centres() -> str:
    return f"""
first_points AS (SELECT * FROM points ORDER BY {POINT_COLUMNS} LIMIT {S.CLUSTERS}),
centres AS (
  SELECT row_number() OVER (ORDER BY {POINT_COLUMNS}) - 1 AS cluster, x AS cx, y AS cy FROM first_points
),
numbered AS (SELECT *, row_number() OVER () AS rid FROM points),
measured AS (
  SELECT rid, cluster, (x - cx) * (x - cx) + (y - cy) * (y - cy) AS distance FROM numbered, centres
),
nearest AS (
  SELECT rid, CAST(min(cluster) AS INTEGER) AS cluster
  FROM measured JOIN (SELECT rid, min(distance) AS distance FROM measured GROUP BY rid) USING (rid, distance)
  GROUP BY rid
),
clustered AS (SELECT {POINT_COLUMNS}, cluster FROM numbered JOIN nearest USING (rid))"""


def _lloyd() -> str:
    """Round after round for every start: the nearest centre of each point, then the means."""
    nearest = """
far{0} AS MATERIALIZED (
  SELECT start, rid, x, y, min((x - cx) * (x - cx) + (y - cy) * (y - cy)) AS d,
         arg_min(cluster, struct_pack(d := (x - cx) * (x - cx) + (y - cy) * (y - cy), k := cluster)) AS cluster
  FROM numbered, centres{0} GROUP BY ALL
)"""
    parts = [
        f"""
numbered AS (SELECT *, row_number() OVER () AS rid FROM points),
drawn AS (
  SELECT start, x, y, row_number() OVER (PARTITION BY start ORDER BY md5(concat_ws(':', 0, start, {POINT_COLUMNS.removesuffix(', x, y')})), x, y) AS nth
  FROM points, range({S.STARTS}) AS r(start)
),
centres0 AS (SELECT start, nth - 1 AS cluster, x AS cx, y AS cy FROM drawn WHERE nth <= {S.CLUSTERS})"""
    ]
    for k in range(S.ROUNDS):
        parts.append(nearest.format(k))
        parts.append(f"""
centres{k + 1} AS MATERIALIZED (
  SELECT start, cluster, coalesce(mx, cx) AS cx, coalesce(my, cy) AS cy FROM centres{k} LEFT JOIN (
    SELECT start, cluster, CAST(sum(CAST(round(x * {S.SUM_SCALE}) AS HUGEINT)) AS DOUBLE) / count(*) / {float(S.SUM_SCALE)} AS mx,
           CAST(sum(CAST(round(y * {S.SUM_SCALE}) AS HUGEINT)) AS DOUBLE) / count(*) / {float(S.SUM_SCALE)} AS my
    FROM far{k} GROUP BY start, cluster
  ) USING (start, cluster)
)""")
    parts.append(nearest.format(S.ROUNDS))
    parts.append(f"""
last_centres AS (SELECT * FROM centres{S.ROUNDS}),
last_sizes AS (SELECT start, cluster, count(*) AS n FROM far{S.ROUNDS} GROUP BY start, cluster),
best AS (
  SELECT start FROM far{S.ROUNDS} GROUP BY start
  ORDER BY sum(CAST(round(d * {S.SUM_SCALE}) AS HUGEINT)), start LIMIT 1
)""")
    return ",".join(parts)


def _lineitem_tree(threshold: int, *more: str, max_heavy: int | None = None) -> str:
    return _with(POINTS, BOX, _tree(threshold, max_heavy=max_heavy), *more)


def _vector_tree(*more: str) -> str:
    return _with(VECTORS, BOX, _tree(S.VECTOR_THRESHOLD, VECTOR_COLUMNS), *more)


def _event_tree(*more: str) -> str:
    return _with(EVENTS, BOX, _tree(S.EVENT_THRESHOLD, EVENT_COLUMNS, depth=S.EVENT_DEPTH), *more)


HELD = "count(*) AS n, CAST(sum(strlen(data)) AS BIGINT) AS bytes"
TAXED = "CASE WHEN l_tax > 0 THEN l_tax END"
CATALOGUE_LINE = _line([*LINEITEM_COLUMNS, TAXED])
SHIPPED = "left(CAST(l_shipdate AS VARCHAR), 10) || ' 12:30:00'"
ODD_LINE = _line(["l_orderkey", "l_linenumber", "l_suppkey", SHIPPED, "l_extendedprice", "l_quantity"])


def _ddl_columns() -> str:
    kinds = dict.fromkeys(("l_orderkey", "l_partkey", "l_suppkey"), "NUMBER(19, 0)")
    kinds |= {"l_linenumber": "NUMBER(10, 0)"}
    kinds |= dict.fromkeys(("l_returnflag", "l_linestatus", "l_shipdate"), "char(19)")
    rows = [
        f"SELECT CAST({at} AS INTEGER) AS ordinal, '{name}' AS name, '{kinds.get(name, 'FLOAT (24)')}' AS ddl_type, "
        f"{str(name != 'taxed').lower()} AS not_null, "
        f"count(*) FILTER ({TAXED if name == 'taxed' else name} IS NULL) AS nulls FROM lineitem"
        for at, name in enumerate([*LINEITEM_COLUMNS, "taxed"])
    ]
    return "\nUNION ALL ".join(rows)


def _fields() -> str:
    texts = [f"coalesce(CAST({c} AS VARCHAR), 'NULL') AS {c}" for c in LINEITEM_COLUMNS]
    texts.append(f"coalesce(CAST({TAXED} AS VARCHAR), 'NULL') AS taxed")
    return f"SELECT CAST({len(texts)} AS INTEGER) AS n_fields, {', '.join(texts)} FROM lineitem"


def _rectangles() -> str:
    """The list of rectangles, and the first that holds each row."""
    return """
listed AS (
  SELECT 'g' || CAST(i AS VARCHAR) || CAST(j AS VARCHAR) AS cell,
         x0 + i * ((x1 - x0) / 4) AS a, x0 + (i + 1) * ((x1 - x0) / 4) AS b,
         y0 + j * ((y1 - y0) / 4) AS c, y0 + (j + 1) * ((y1 - y0) / 4) AS d
  FROM box, range(1, 3) AS r(i), range(1, 3) AS s(j)
  UNION ALL SELECT 'q1', x0, (x0 + x1) / 2, y0, (y0 + y1) / 2 FROM box
  UNION ALL SELECT 'q2', (x0 + x1) / 2, x1, y0, (y0 + y1) / 2 FROM box
  UNION ALL SELECT 'q3', (x0 + x1) / 2, x1, (y0 + y1) / 2, y1 FROM box
),
numbered AS (SELECT *, row_number() OVER () AS rid FROM points),
held AS (
  SELECT rid, min(cell) AS cell FROM numbered JOIN listed ON x BETWEEN a AND b AND y BETWEEN c AND d GROUP BY rid
)"""


def _nested_rectangles() -> str:
    """Every row against every extent; the least area, then the least name, holds it."""
    extents = " UNION ALL ".join(
        f"SELECT '{kind}' || {key} AS cell, min(x) AS a, max(x) AS b, min(y) AS c, max(y) AS d FROM rows GROUP BY {key}"
        for kind, key in (("p", "l_partkey"), ("s", "l_suppkey"))
    )
    return _with(
        "rows AS (SELECT *, l_extendedprice AS x, l_quantity AS y, row_number() OVER () AS rid FROM lineitem)",
        f"extents AS ({extents})",
        "listed AS (SELECT *, row_number() OVER (ORDER BY CAST(round((b - a) * (d - c) * 100) AS BIGINT), cell) AS pos FROM extents)",
        """held AS (
  SELECT rid, arg_min(listed.cell, pos) AS cell FROM rows JOIN listed ON x BETWEEN a AND b AND y BETWEEN c AND d GROUP BY rid
)""",
    ) + f"SELECT {POINT_COLUMNS}, cell FROM rows JOIN held USING (rid)"


def _placed_rows() -> str:
    """A split built on some rows, then every row descended through its rectangles, first one first."""
    some = POINTS.strip().removesuffix(")").rstrip() + " WHERE l_linenumber > 1\n)"
    every = "every AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS x, l_quantity AS y FROM lineitem)"
    numbered = "numbered AS (SELECT *, row_number() OVER () AS rid FROM every)"
    held = """
held AS (
  SELECT rid, min(cell) AS cell FROM numbered JOIN box
    ON x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1
  JOIN (SELECT cell, x0 AS a, x1 AS b, y0 AS c, y1 AS d FROM leaves) ON x BETWEEN a AND b AND y BETWEEN c AND d
  GROUP BY rid
)"""
    return _with("\n" + some, BOX, _tree(S.THRESHOLD), every, numbered, held) + (
        f"SELECT {POINT_COLUMNS}, cell FROM numbered LEFT JOIN held USING (rid)"
    )


def _grown_split() -> str:
    """All rows split together, in the box of those that came first."""
    every = f"every AS (SELECT l_linenumber > 2 AS early, {CATALOGUE_LINE} AS data, l_extendedprice AS x, l_quantity AS y FROM lineitem)"
    box = "box AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM every WHERE early)"
    inside = "points AS (SELECT data, x, y FROM every, box WHERE x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1)"
    return _with(every, box, inside, _tree(S.THRESHOLD, "data, x, y")) + f"""
SELECT cell, {HELD} FROM assigned GROUP BY cell
UNION ALL
SELECT NULL, {HELD} FROM every, box WHERE NOT (x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1) HAVING count(*) > 0"""


def oracles() -> dict[str, str]:
    lineitem_tree = _lineitem_tree(S.THRESHOLD)
    merged = _lineitem_tree(S.THRESHOLD, _merge(S.MINIMUM))
    ranges = _lineitem_tree(S.THRESHOLD, _merge(S.MINIMUM), _ranges())
    assigned_groups = f"SELECT {POINT_COLUMNS}, id_part FROM assigned JOIN groups USING (cell)"
    uniform = _with(POINTS, BOX, _uniform(S.GRID))
    catalogue_points = (
        f"points AS (SELECT {CATALOGUE_LINE} AS data, l_extendedprice AS x, l_quantity AS y FROM lineitem)"
    )
    leaf_columns = "cell, CAST(depth AS INTEGER) AS depth, n, x0, x1, y0, y1"
    return {
        "bbox": _with(POINTS, BOX) + "SELECT * FROM box",
        "uniform_cells": uniform + "SELECT cell, a AS x0, b AS x1, c AS y0, d AS y1 FROM grid",
        "uniform_assign": uniform + "SELECT * FROM tagged",
        "uniform_hist": uniform + "SELECT cell, count(*) AS n FROM tagged GROUP BY cell",
        "uniform_hist_wide": _with(POINTS, BOX, _uniform(S.WIDE_GRID))
        + "SELECT cell, count(*) AS n FROM tagged GROUP BY cell",
        "cell_rows": uniform + "SELECT * FROM tagged WHERE cell = '37'",
        "quadrant_cells": _with(POINTS, BOX)
        + """
SELECT '1' AS cell, x0, (x0 + x1) / 2 AS x1, y0, (y0 + y1) / 2 AS y1 FROM box
UNION ALL SELECT '2', (x0 + x1) / 2, x1, y0, (y0 + y1) / 2 FROM box
UNION ALL SELECT '3', (x0 + x1) / 2, x1, (y0 + y1) / 2, y1 FROM box
UNION ALL SELECT '4', x0, (x0 + x1) / 2, (y0 + y1) / 2, y1 FROM box""",
        "quadrants": _with(POINTS, BOX)
        + f"""
SELECT {POINT_COLUMNS},
       CASE WHEN x <= (x0 + x1) / 2 AND y <= (y0 + y1) / 2 THEN '1'
            WHEN x >= (x0 + x1) / 2 AND y <= (y0 + y1) / 2 THEN '2'
            WHEN x >= (x0 + x1) / 2 AND y >= (y0 + y1) / 2 THEN '3' ELSE '4' END AS cell
FROM points, box""",
        "quad_paths": _with(POINTS, BOX, _levels(S.PATH_DEPTH, POINT_COLUMNS))
        + f"SELECT {POINT_COLUMNS}, cell FROM level{S.PATH_DEPTH}",
        "grid_step": _with(POINTS, BOX, _levels(S.STEP_GRID_DEPTH, POINT_COLUMNS))
        + f"""
SELECT cell, x0, x1, y0, y1 FROM cells WHERE depth = {S.STEP_GRID_DEPTH} AND n <= {S.STEP_THRESHOLD}
UNION ALL
SELECT cell || CAST(q AS VARCHAR),
       CASE WHEN q IN (0, 3) THEN x0 ELSE (x0 + x1) / 2 END, CASE WHEN q IN (0, 3) THEN (x0 + x1) / 2 ELSE x1 END,
       CASE WHEN q IN (0, 1) THEN y0 ELSE (y0 + y1) / 2 END, CASE WHEN q IN (0, 1) THEN (y0 + y1) / 2 ELSE y1 END
FROM cells, range(4) AS r(q) WHERE depth = {S.STEP_GRID_DEPTH} AND n > {S.STEP_THRESHOLD}""",
        "level_counts": _with(POINTS, BOX, _levels(S.PATH_DEPTH, POINT_COLUMNS))
        + "SELECT cell, CAST(depth AS INTEGER) AS depth, n FROM cells",
        "quadtree_leaves": lineitem_tree + f"SELECT {leaf_columns} FROM leaves",
        "quadtree_capped": _lineitem_tree(S.CAPPED_THRESHOLD, max_heavy=S.MAX_HEAVY_CELLS)
        + f"SELECT {leaf_columns} FROM leaves",
        "quadtree_assign": lineitem_tree + "SELECT * FROM assigned",
        "quadtree_vectors": _vector_tree() + "SELECT * FROM assigned",
        "quadtree_events": _event_tree() + "SELECT * FROM assigned",
        "event_leaves": _event_tree() + f"SELECT {leaf_columns} FROM leaves",
        "unfinished_rows": _event_tree()
        + f"""
SELECT {EVENT_COLUMNS} FROM level{S.HEAVY_DEPTH}
WHERE cell IN (SELECT cell FROM cells WHERE depth = {S.HEAVY_DEPTH} AND n > {S.EVENT_THRESHOLD})""",
        "merged_cells": merged + "SELECT * FROM groups",
        "merged_vectors": _vector_tree(_merge(S.VECTOR_MINIMUM)) + "SELECT * FROM groups",
        "merged_events": _event_tree(_merge(S.EVENT_MINIMUM)) + "SELECT * FROM groups",
        "merged_runs": _lineitem_tree(S.THRESHOLD, _merge(S.LARGE_MINIMUM))
        + """
SELECT min(cell) AS part, max(cell) AS last, count(*) AS members, group_n FROM groups GROUP BY id_part, group_n""",
        "merged_id_pages": _event_tree(_merge(S.EVENT_MINIMUM))
        + f"""
SELECT part, page, string_agg(cell, '' ORDER BY cell) AS ids FROM (
  SELECT cell, min(cell) OVER (PARTITION BY id_part) AS part,
         (row_number() OVER (PARTITION BY id_part ORDER BY cell) - 1) // {S.PAGE_MEMBERS} AS page FROM groups
) GROUP BY part, page""",
        "found_runs": merged
        + f"""
SELECT c.cell, coalesce(max(part), (SELECT min(cell) FROM groups)) AS part
FROM (SELECT DISTINCT cell FROM level{S.PATH_DEPTH}) c
LEFT JOIN (SELECT min(cell) AS part FROM groups GROUP BY id_part) ON part <= c.cell GROUP BY c.cell""",
        "merged_report_lines": ranges
        + """
SELECT substr(id_part, 1, instr(substr(id_part, 2) || '_', '_')) AS part, pos,
       'x dans [' || CAST(x0 AS VARCHAR) || ', ' || CAST(x1 AS VARCHAR) || '] et y dans ['
       || CAST(y0 AS VARCHAR) || ', ' || CAST(y1 AS VARCHAR) || ']' AS line
FROM (SELECT id_part, CAST(pos AS BIGINT) AS pos, x0, x1, y0, y1 FROM ranges)
UNION ALL
SELECT part, -1, 'La partition ' || part || 'corespond a' FROM (SELECT min(cell) AS part FROM groups GROUP BY id_part)""",
        "merged_assign": merged + assigned_groups,
        "merged_retag": merged + assigned_groups,
        "merged_ranges": ranges + "SELECT * FROM ranges",
        "merged_report": ranges
        + """
SELECT id_part, 'La partition ' || id_part || 'corespond a' || chr(10) || string_agg(
    'x dans [' || CAST(x0 AS VARCHAR) || ', ' || CAST(x1 AS VARCHAR) || '] et y dans ['
    || CAST(y0 AS VARCHAR) || ', ' || CAST(y1 AS VARCHAR) || ']', chr(10) ORDER BY pos) AS report
FROM ranges GROUP BY id_part""",
        "block_partitions": _with(
            POINTS,
            BOX,
            f"""
estimate AS MATERIALIZED (
  SELECT CAST(floor(avg({float(S.SMALL_BLOCK_BYTES)} / strlen({LINE}))) AS BIGINT) AS per_file FROM lineitem
)""",
            _tree("(SELECT per_file FROM estimate)"),
            _merge(S.BLOCK_MINIMUM),
        )
        + "SELECT id_part, CAST(sum(n) AS BIGINT) AS n FROM groups GROUP BY id_part",
        "cell_balance": _with(
            f"points AS (SELECT {LINE} AS line, l_extendedprice AS x, l_quantity AS y FROM lineitem)",
            BOX,
            _tree(S.THRESHOLD, "line, x, y"),
        )
        + """
SELECT cell, count(*) AS n, CAST(sum(strlen(line)) AS BIGINT) AS bytes,
       CAST(max(length(cell)) - 1 AS INTEGER) AS depth
FROM assigned GROUP BY cell""",
        "csv_lines": f"SELECT {LINE} AS line FROM lineitem",
        "cell_text": _with(POINTS, BOX, _uniform(S.GRID), _pages())
        + """
SELECT cell, page, piece, count(*) AS n, string_agg(line, chr(10) ORDER BY line) AS text
FROM repeated GROUP BY cell, page, piece""",
        "cell_collect": _with(POINTS, BOX, _uniform(S.GRID), _pages())
        + """
SELECT cell, page, piece, line FROM repeated""",
        "rows_per_file": f"SELECT CAST(floor(avg(128000000.0 / strlen({LINE}))) AS BIGINT) AS rows_per_file FROM lineitem",
        "object_records": """
SELECT l_partkey AS object_id, 1 AS n, l_orderkey AS source_id, l_extendedprice AS x_low,
       l_extendedprice AS x_high, l_quantity AS y_low, l_quantity AS y_high FROM lineitem""",
        "object_summary": """
SELECT l_partkey AS object_id, count(*) AS n, max(l_orderkey) AS source_id, min(l_extendedprice) AS x_low,
       max(l_extendedprice) AS x_high, min(l_quantity) AS y_low, max(l_quantity) AS y_high
FROM lineitem GROUP BY l_partkey""",
        "cell_index": lineitem_tree + "SELECT cell, dense_rank() OVER (ORDER BY cell) - 1 AS idx FROM leaves",
        "distinct_cells": lineitem_tree + "SELECT DISTINCT cell FROM assigned",
        "sorted_counts": lineitem_tree + "SELECT cell, n FROM leaves ORDER BY cell",
        "unwritten_rows": lineitem_tree
        + f"""
SELECT * FROM assigned WHERE cell NOT IN (SELECT cell FROM leaves WHERE n >= {S.WRITTEN_ROWS})""",
        "first_rows": _with(POINTS) + f"SELECT * FROM points ORDER BY {POINT_COLUMNS} LIMIT {S.FIRST_ROWS}",
        "cluster_assign": _with(POINTS, _centres()) + "SELECT * FROM clustered",
        "cluster_sizes": _with(POINTS, _centres())
        + "SELECT cluster, count(*) AS n FROM clustered GROUP BY cluster ORDER BY n, cluster",
        "csv_roundtrip": f"""
SELECT * REPLACE (CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_shipdate AS VARCHAR) AS l_shipdate),
       {TAXED} AS taxed FROM lineitem""",
        "odd_definition": f"""
SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber, {SHIPPED} AS shipped,
       l_extendedprice, l_quantity FROM lineitem""",
        "odd_definition_lines": f"SELECT {ODD_LINE} AS data, l_extendedprice AS x, l_quantity AS y FROM lineitem",
        "field_rows": _fields(),
        "cluster_check": f"""
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS unplaced, CAST(0 AS BIGINT) AS misplaced,
       CAST({S.CLUSTERS} AS BIGINT) AS centres, true AS numbered FROM lineitem""",
        "cluster_starts": _with(POINTS, _lloyd())
        + """
SELECT CAST(c.start AS INTEGER) AS start, CAST(c.cluster AS INTEGER) AS cluster, cx, cy, coalesce(n, 0) AS n
FROM last_centres c JOIN best USING (start) LEFT JOIN last_sizes USING (start, cluster)""",
        "given_rectangles": _with(POINTS, BOX, _rectangles())
        + f"SELECT {POINT_COLUMNS}, coalesce(cell, '-1') AS cell FROM numbered LEFT JOIN held USING (rid)",
        "nested_rectangles": _nested_rectangles(),
        "placed_rows": _placed_rows(),
        "quadrant_job": _with(catalogue_points, BOX)
        + f"""
SELECT CASE WHEN x <= (x0 + x1) / 2 AND y <= (y0 + y1) / 2 THEN '1'
            WHEN x >= (x0 + x1) / 2 AND y <= (y0 + y1) / 2 THEN '2'
            WHEN x >= (x0 + x1) / 2 AND y >= (y0 + y1) / 2 THEN '3' ELSE '4' END AS cell, {HELD}
FROM points, box GROUP BY 1""",
        "ddl_columns": _ddl_columns(),
        "partitioned_roundtrip": _lineitem_tree(S.FILE_THRESHOLD) + "SELECT * FROM assigned",
        "written_cell": _lineitem_tree(S.FILE_THRESHOLD)
        + f"SELECT * FROM assigned WHERE cell = '{S.WRITTEN_CELL}'",
        "uniform_job": _with(
            catalogue_points,
            BOX,
            _uniform(S.GRID, "data"),
        )
        + f"SELECT cell, {HELD} FROM tagged GROUP BY cell",
        "quadtree_job": _with(catalogue_points, BOX, _tree(S.FILE_THRESHOLD, "data, x, y"))
        + f"SELECT cell, {HELD} FROM assigned GROUP BY cell",
        "merged_job": _with(
            catalogue_points, BOX, _tree(S.THRESHOLD, "data, x, y"), _merge(S.MINIMUM)
        )
        + f"SELECT id_part, {HELD} FROM assigned JOIN groups USING (cell) GROUP BY id_part",
        "text_roundtrip": _with(
            f"points AS (SELECT {LINE} AS data, l_extendedprice AS x, l_quantity AS y FROM lineitem)",
            BOX,
            _tree(S.THRESHOLD, "data, x, y"),
            _merge(S.MINIMUM),
        )
        + "SELECT data, id_part FROM assigned JOIN groups USING (cell)",
        "dealt_cells": lineitem_tree
        + f"""
SELECT cell, n, CAST(floor(coalesce(before, 0) * shares / total) AS INTEGER) AS task FROM (
  SELECT cell, n, sum(n) OVER (ORDER BY cell ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
         sum(n) OVER () AS total, greatest(1, least({S.TASKS}, sum(n) OVER () // {S.DEALT_ROWS})) AS shares
  FROM leaves WHERE n <= {S.DEALT_ROWS}
)""",
        "written_balance": _with(catalogue_points, BOX, _tree(S.FILE_THRESHOLD, "data, x, y"))
        + """
SELECT cell, count(*) AS n, CAST(sum(strlen(data) + 1) AS BIGINT) AS bytes, true AS enough_files
FROM assigned GROUP BY cell""",
        "line_sources": f"SELECT {LINE} AS data, l_returnflag AS flag, true AS placed FROM lineitem",
        "rejected_lines": f"""
SELECT count(*) + 7 AS lines, CAST(4 AS BIGINT) AS short, CAST(2 AS BIGINT) AS bad_x, CAST(1 AS BIGINT) AS bad_y,
       count(*) AS kept, CAST(sum(strlen({CATALOGUE_LINE})) AS BIGINT) AS bytes FROM lineitem""",
        "region_rows": lineitem_tree
        + f"""
SELECT * FROM assigned WHERE x BETWEEN {S.REGION[0]} AND {S.REGION[1]} AND y BETWEEN {S.REGION[2]} AND {S.REGION[3]}""",
        "grown_split": _grown_split(),
        "one_file_per_cell": _lineitem_tree(S.FILE_THRESHOLD)
        + "SELECT cell, n, true AS one_file FROM leaves",
    }
