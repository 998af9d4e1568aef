"""Tool-call linking with DataFrame functions alone.

Calls and results meet by identifier in a hash join. A call may wait for one
earlier call (``after``); calls stand in topological order by their depth in
that forest, found by pointer doubling in logarithmically many rounds. Their
position within a group comes from one range sort over all calls and counts per
range, so that a group of any size spreads over tasks. Arguments are checked
against the tool's schema, and every call becomes one canonical JSON record:
fixed keys in sorted order, no spaces.

Defined results: calls without an id are kept, unlinked. Of calls with one id
the first (by group, turn, then name, arguments and after) is the call and the
others are ``duplicate``, rows equal to it in everything too; the first result
at or after nothing else but its id is linked, the same way. A call without a
result has a null result. An ``after`` that names no call counts as none
(``unknown_after``). Calls in a cycle have a null depth and come last in their
group. Null or broken arguments are invalid. A whole number is an integer
however it is written and however long it is. Results that no call asked for
come from ``orphans``. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstone.session import materialize

#: JSON types an argument can be asked for, and how the parsed value's type is spelled.
_TYPES = {
    "string": "^STRING$", "integer": "^(BIGINT|DOUBLE|DECIMAL.*)$", "number": "^(BIGINT|DOUBLE|DECIMAL.*)$", "boolean": "^BOOLEAN$",
    "object": "^OBJECT<.*", "array": "^ARRAY<.*",
}


@dataclass(frozen=True)
class Argument:
    name: str
    kind: str = "string"
    required: bool = True


#: Equal rows that one step unfolds together, and places of the row number in a generated id.
_COPIES = 1024
_ROW_BITS = 33


def _argument(parsed: Column, name: str) -> Column:
    """The argument of this name, which may hold any signs but both kinds of quotes."""
    quote = "'" if '"' in name else '"'
    if not name or quote in name:
        raise ValueError(f"no path leads to an argument named {name!r}")
    return F.try_variant_get(parsed, f"$[{quote}{name}{quote}]", "variant")


def _fits(value: Column, kind: str) -> Column:
    typed = F.schema_of_variant(value).rlike(_TYPES[kind])
    if kind != "integer":
        return typed
    # as it is written out: no digit but zeros behind the point
    return typed & F.coalesce(F.try_variant_get(value, "$", "string").rlike(r"^-?\d+(\.0*)?(E\+?\d+)?$"), F.lit(False))


def validity(tool: Column, arguments: Column, schemas: dict[str, list[Argument]]) -> Column:
    """Null where the arguments fit the tool's schema, else what is wrong first."""
    parsed = F.try_parse_json(arguments)
    problem = F.when(arguments.isNull(), "no arguments").when(parsed.isNull(), "broken json")
    problem = problem.when(~F.schema_of_variant(parsed).startswith("OBJECT"), "not an object")
    for name, wanted in sorted(schemas.items()):
        for a in wanted:
            value = _argument(parsed, a.name)
            missing = value.isNull() | F.is_variant_null(value)
            here = tool == F.lit(name)
            if a.required:
                problem = problem.when(here & missing, f"missing {a.name}")
            problem = problem.when(here & ~missing & ~_fits(value, a.kind), f"{a.name} is not {a.kind}")
    return problem.when(~tool.isin(sorted(schemas)) | tool.isNull(), "unknown tool")


def depths(calls: DataFrame) -> DataFrame:
    """(id, depth) of a forest (id unique and not null, after): 0 for roots, null in cycles and beneath them.

    Every round each open call skips to the end of its skip's skip, so chains of
    n calls take log n rounds.
    """
    roots = calls.where("after is null").select("id", F.lit(0).cast("long").alias("depth"))
    open_ = materialize(calls.where("after is not null").select("id", F.col("after").alias("skip"), F.lit(1).cast("long").alias("steps")), "skips")
    done = materialize(roots, "depths")
    left = open_.count()
    longest = left.bit_length() + 1
    for _ in range(longest):
        if not left:
            break
        ends = done.select(F.col("id").alias("_id"), F.col("depth").alias("_depth"))
        met = open_.join(ends, F.col("skip") == F.col("_id"), "left")
        step = materialize(met.select("id", "skip", "steps", (F.col("_depth") + F.col("steps")).alias("depth")), "skips")
        fresh = step.where("depth is not null").select("id", "depth")
        rest = step.where("depth is null").select("id", "skip", "steps")
        far = rest.select(F.col("id").alias("_id"), F.col("skip").alias("_skip"), F.col("steps").alias("_steps"))
        # a call whose skip was settled in this very round meets it in the next
        open_ = rest.join(far, F.col("skip") == F.col("_id"), "left").select(
            "id", F.coalesce("_skip", "skip").alias("skip"), (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps")
        )
        open_ = materialize(open_, "skips")
        done = done.union(fresh)
        now = open_.count()
        left = now
    return done.union(open_.select("id", F.lit(None).cast("long").alias("depth")))


def _first(rows: DataFrame, order: list[str], carried: list[str]) -> DataFrame:
    """One row per id, the first in order; partial minima, so no id is gathered."""
    rest = [c for c in carried if c not in order]
    return rows.groupBy("id").agg(F.min(F.struct(*order, *rest)).alias("_f")).select("id", *[F.col(f"_f.{c}").alias(c) for c in carried])


def positions(calls: DataFrame) -> DataFrame:
    """The calls with ``position``: 1, 2, ... within their group, by depth (null last), turn and id."""
    order = ["group", F.asc_nulls_last("depth"), "turn", F.asc_nulls_last("id"), "_copy"]
    parts = int(calls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = calls.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = materialize(sorted_.withColumn("_seq", F.monotonically_increasing_id()), "placed")
    spot = placed.withColumn("_part", F.shiftright("_seq", _ROW_BITS)).withColumn("_row", F.col("_seq").bitwiseAND((1 << _ROW_BITS) - 1))
    runs = spot.groupBy(F.col("group").alias("_group"), "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))  # one row a group and range
    before = F.sum("_n").over(Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("_group", F.col("_part").alias("_at"), (F.coalesce(before, F.lit(0)) - F.col("_first") + 1).alias("_base"))
    met = spot.join(runs, F.col("group").eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_at")))
    return met.withColumn("position", F.col("_row") + F.col("_base")).drop("_seq", "_part", "_row", "_group", "_at", "_base")


def _with_copies(calls: DataFrame) -> DataFrame:
    """Every row with its number among the rows equal to it; they are counted first and unfolded in steps."""
    counted = calls.groupBy(*calls.columns).agg(F.count("*").alias("_n"))
    last = F.floor((F.col("_n") - 1) / _COPIES).cast("long")
    parcels = counted.withColumn("_parcel", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    low = F.col("_parcel") * _COPIES
    high = F.least(low + _COPIES, F.col("_n")) - 1
    return parcels.withColumn("_copy", F.explode(F.sequence(low, high))).drop("_n", "_parcel")


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, list[Argument]]) -> DataFrame:
    """One row per call.

    ``calls``: group, turn, id, name, arguments (JSON text), after. ``results``:
    id, turn, content. Gives group, turn, id, name, depth, position, status,
    problem, result_turn, unknown_after and record (canonical JSON); ``status`` is
    linked, pending, duplicate or cyclic. The position of a call in its group, from
    1, is by depth, then turn, then id, so that no call stands before the one it
    waits for.
    """
    calls = calls.select("group", "turn", F.col("id").cast("string").alias("id"), "name", "arguments", F.col("after").cast("string").alias("after"))
    named = calls.where("id is not null")
    order = ["group", "turn", "name", "arguments", "after"]
    lead = named.groupBy("id").agg(F.min(F.struct("group", "turn", F.xxhash64("name", "arguments", "after").alias("h"))).alias("_lead"))
    answers = results.where("id is not null").groupBy(F.col("id").cast("string").alias("_id")).agg(F.min(F.struct("turn", "content")).alias("_answer"))
    ids = materialize(named.select("id", "group", "turn", F.xxhash64("name", "arguments", "after").alias("h"), "after").join(lead, "id").where(
        F.struct("group", "turn", "h") == F.col("_lead")).groupBy("id").agg(F.min("after").alias("after")), "calls")
    known = ids.select(F.col("id").alias("_known"))
    forest = ids.join(known, F.col("after") == F.col("_known"), "left").select("id", F.col("_known").alias("after"), (F.col("after").isNotNull() & F.col("_known").isNull()).alias("unknown_after"))
    forest = materialize(forest, "forest")
    deep = depths(forest.select("id", "after")).join(forest.select("id", "unknown_after"), "id")
    facts = deep.join(lead, "id").select(F.col("id").alias("_call"), "depth", "unknown_after", "_lead")
    tagged = _with_copies(calls).join(facts, F.col("id") == F.col("_call"), "left")
    linked = tagged.join(answers, F.col("id") == F.col("_id"), "left")
    chosen = F.struct("group", "turn", F.xxhash64("name", "arguments", "after")).eqNullSafe(F.col("_lead")) & (F.col("_copy") == 0)
    first = F.col("id").isNull() | chosen
    status = (
        F.when(~first, "duplicate").when(F.col("id").isNotNull() & F.col("depth").isNull(), "cyclic")
        .when(F.col("_answer").isNull(), "pending").otherwise("linked")
    )
    problem = validity(F.col("name"), F.col("arguments"), schemas)
    answer = F.when(status == "linked", F.col("_answer.content"))
    depth = F.when(F.col("id").isNull(), F.lit(0).cast("long")).otherwise(F.col("depth"))
    flat = linked.select(
        "group", "turn", "id", "name", depth.alias("depth"), status.alias("status"), problem.alias("problem"),
        F.when(status == "linked", F.col("_answer.turn")).alias("result_turn"), F.coalesce("unknown_after", F.lit(False)).alias("unknown_after"),
        canonical(F.col("id"), F.col("name"), F.col("arguments"), F.col("after"), answer).alias("record"), "_copy",
    )
    columns = ["group", "turn", "id", "name", "depth", "position", "status", "problem", "result_turn", "unknown_after", "record"]
    return positions(flat).select(*columns)


def canonical(id_: Column, name: Column, arguments: Column, after: Column, result: Column) -> Column:
    """One JSON object, keys sorted at every level, without spaces; broken arguments become a string."""
    parsed = F.try_parse_json(arguments)
    sound = F.when(parsed.isNotNull(), F.to_json(parsed)).otherwise(F.coalesce(_quoted(arguments), F.lit("null")))
    pairs = [("after", F.coalesce(_quoted(after), F.lit("null"))), ("arguments", sound), ("id", F.coalesce(_quoted(id_), F.lit("null"))),
             ("name", F.coalesce(_quoted(name), F.lit("null"))), ("result", F.coalesce(_quoted(result), F.lit("null")))]
    out: list[Column] = [F.lit("{")]
    for i, (key, value) in enumerate(pairs):
        out += [F.lit(f'{"," if i else ""}"{key}":'), value]
    return F.concat(*out, F.lit("}"))


def _quoted(text: Column) -> Column:
    """A JSON string literal."""
    literal = F.to_json(F.struct(text.alias("v")))
    return F.when(text.isNotNull(), F.substring(literal, F.lit(6), F.length(literal) - 6))


def orphans(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Results whose id no call has, or that have none."""
    known = calls.select(F.col("id").cast("string").alias("_known")).where("_known is not null").distinct()
    return results.join(known, F.col("id").cast("string") == F.col("_known"), "left_anti")
