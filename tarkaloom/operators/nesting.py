"""Deeply nested records as flat tables with parent–child links.

A payload is parsed once into VARIANT.  Each step of :func:`_step` is one
higher-order projection that turns the array of open nodes into the array of
their members, handing on the path of the enclosing commentary; ``flatten``
joins the per-node arrays, and a single ``inline`` emits the rows at the end.
The projection is unrolled for ``LEVELS`` levels of JSON; the open nodes of deeper
rows are staged and go through the same projection again until none is open, so no
depth is cut and the source is read once.

Of a key that an object repeats, the last value counts, as in most JSON readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarkaloom.plans.session import stage

LEVELS = 4
MEMBERS = ("commentaries", "commentary")
_NODE = "struct<m:map<string,variant>,a:array<variant>,path:string,parent:string,com:boolean,rec:int>"


def _last_key_wins(spark: SparkSession) -> None:
    """Without this setting Spark's parser takes an object with a repeated key for broken.

    It is read when a plan runs, so it stays set in the session.
    """
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def _let(value: str, name: str, body: str) -> str:
    """Bind a value once inside a higher-order expression."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _members(v: str) -> str:
    """``m`` (members) or ``a`` (elements) of a variant; both null for scalars.

    A string that holds an object or array counts as what it holds.  Every value is
    cast once, as each cast copies the subtree.
    """
    pair = lambda x: f"named_struct('m', try_cast({x} as map<string,variant>), 'a', try_cast({x} as array<variant>))"
    held = _let(f"try_cast({v} as string)", "s", "try_parse_json(if(substr(trim(leading ' \\t\\n\\r' from s), 1, 1) in ('{', '['), s, null))")
    return _let(pair(v), "c", f"if(c.m is not null or c.a is not null, c, {_let(held, 'p', pair('p'))})")


def _node(c: str, path: str, parent: str, com: str, rec: str = "n.rec") -> str:
    return f"named_struct('m', {c}.m, 'a', {c}.a, 'path', {path}, 'parent', {parent}, 'com', {com}, 'rec', {rec})"


def _step(names: tuple[str, ...]) -> str:
    """SQL that maps ``open`` (array of nodes) to the nodes one level of JSON down."""
    named = "e.key in (" + ",".join(f"'{n}'" for n in names) + ")"
    at = "if(n.path = '', cast(i as string), concat(n.path, '.', i))"
    # Elements of a commentary member that are objects are commentaries; an array
    # inside the array is walked on as plain structure.
    one = lambda i: _node("q", f"if(q.m is not null, {at.replace('(i ', f'({i} ').replace(', i)', f', {i})')}, n.path)", "n.path", "q.m is not null")
    coms = f"if(w.a is not null, transform(w.a, (x, i) -> {_let(_members('x'), 'q', one('i'))}), {_let('w', 'q', f'array({one(0)})')})"
    plain = f"array({_node('w', 'n.path', 'n.parent', 'false')})"
    of_object = f"flatten(transform(map_entries(n.m), e -> {_let(_members('e.value'), 'w', f'if({named}, {coms}, {plain})')}))"
    # outside commentaries the place in the innermost array is the record's
    of_array = f"transform(n.a, (x, k) -> {_let(_members('x'), 'w', _node('w', 'n.path', 'n.parent', 'false', 'if(n.path = ' + chr(39) * 2 + ', k, n.rec)'))})"
    kids = f"coalesce({of_object}, {of_array}, cast(array() as array<{_NODE}>))"
    return f"filter(flatten(transform(open, n -> {kids})), k -> k.m is not null or k.a is not null)"


def _row() -> str:
    """A result row of a commentary node ``k``."""
    text = lambda v: f"try_cast({v} as string)"
    c = _members("k.m['commentator']")
    name = f"coalesce(if(c2.m is null, {text('k.m[' + chr(39) + 'commentator' + chr(39) + ']')}, {text('c2.m[' + chr(39) + 'name' + chr(39) + ']')}), '')"
    school = f"coalesce(nullif({text('k.m[' + chr(39) + 'school' + chr(39) + ']')}, ''), {text('c2.m[' + chr(39) + 'school' + chr(39) + ']')}, '')"
    return _let(
        c,
        "c2",
        f"named_struct('rec_pos', k.rec, 'node_path', k.path, 'parent_path', k.parent, 'commentator', {name}, 'school', {school}, 'lang', {text('k.m[' + chr(39) + 'lang' + chr(39) + ']')}, 'text', {text('k.m[' + chr(39) + 'text' + chr(39) + ']')})",
    )


def _walk(df: DataFrame, names: tuple[str, ...], levels: int) -> DataFrame:
    """Columns ``raw_id, rows, open`` after ``levels`` steps."""
    for i in range(levels):
        df = df.withColumn("open", F.expr(_step(names)))
        df = df.withColumn(f"rows_{i}", F.expr(f"transform(filter(open, k -> k.com), k -> {_row()})"))
    return df.select("raw_id", F.flatten(F.array(*[F.col(f"rows_{i}") for i in range(levels)])).alias("rows"), "open")


def commentary_tree(raw: DataFrame, key: str = "raw_id", payload: str = "payload", names: tuple[str, ...] = MEMBERS, levels: int = LEVELS) -> DataFrame:
    """One row per commentary object at any depth.

    Columns ``raw_id, rec_pos, node_path, parent_path, commentator, school, lang, text``;
    ``raw_id, rec_pos`` are those of :func:`record_table` (0 for a lone record), ``parent_path`` is
    the ``node_path`` of the parent in the same record.
    Null, empty and broken payloads, null elements and non-object elements give no
    row; a lone object has position 0; repeated payloads give repeated rows; absent
    or null names and schools are ''.
    """
    _last_key_wins(raw.sparkSession)
    v = F.expr(f"try_parse_json(`{payload}`)")
    start = raw.select(F.col(key).alias("raw_id"), v.alias("v")).where("v is not null")
    left = start.select("raw_id", F.expr(f"array({_let(_members('v'), 'w', _node('w', chr(39) * 2, chr(39) * 2, 'false', '0'))})").alias("open"))
    out = None
    while True:
        # a filter on walked rows would be pushed down and repeat the projections, so
        # they are written once
        held = stage(_walk(left, names, levels), "nodes")
        rows = held.selectExpr("raw_id", "inline(rows)")
        out = rows if out is None else out.unionByName(rows)
        left = held.where("size(open) > 0").select("raw_id", "open")
        if left.isEmpty():
            return out


def record_table(raw: DataFrame, key: str = "raw_id", payload: str = "payload") -> DataFrame:
    """The flat parent table: one row per record object (an object with an ``id``),
    also where a payload wraps it in ``record``, ``data.items`` or an array."""
    _last_key_wins(raw.sparkSession)
    v = F.expr(f"try_parse_json(`{payload}`)")
    df = raw.select(F.col(key).alias("raw_id"), v.alias("v")).where("v is not null")
    src = "coalesce(try_cast(v as array<variant>), try_cast(try_variant_get(v, '$.data.items', 'variant') as array<variant>), array(coalesce(try_variant_get(v, '$.record', 'variant'), v)))"
    df = df.select("raw_id", F.posexplode(F.expr(src)).alias("rec_pos", "r"))
    get = lambda p, t: F.expr(f"try_variant_get(r, '{p}', '{t}')")
    return df.select(
        "raw_id", "rec_pos", get("$.id", "string").alias("id"), get("$.source", "string").alias("source"), get("$.ref.chapter", "int").alias("chapter"), get("$.ref.verse", "int").alias("verse"), get("$.text", "string").alias("text")
    ).where("id is not null")
