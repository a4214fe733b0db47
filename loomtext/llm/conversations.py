"""Conversation structure repair: error-correcting Earley parsing of the roles, over blocks of turns.

The role grammar is ``(s?(ua)+)?`` in left-linear form. A chart item is a rule and a dot; its origin is the start of the
parsed rows, as a left-linear grammar predicts there alone. Terminals may be read as they stand (keep), as another role
(rerole) or out of nothing (insert), and every constituent may swallow a row (delete). An item retains its minimum of
(cost, audit): of two audits of one item and cost, none is a prefix of the other, so the least stays least whatever
follows, and the completed chart's item is the cheapest repair of least audit.

A conversation is cut into blocks of 512 turns. A block that may not be the first is parsed from each constituent that
can stand before it, so blocks of one conversation are parsed apart; their results are then put together in order.
The rows' texts are read in a second pass, which turns an audit into the repaired text a row at a time.

Defined cases: null ids, turns, roles and texts: a null id is one conversation, a null turn sorts first, a null role or
text is one space; rows of equal turn go by role and SHA-256 of role and text; repeated rows are duplicates; a role
whose initial is none of s, u, a has to be reroled or deleted; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_TURNS = 512
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Constituents by the last role kept: E nothing, H system, V user, Z assistant; S is the whole. Small letters are roles, d a deleted row.
RULES = (
    ("E", ("E", "d")), ("H", ("E", "s")), ("H", ("H", "d")), ("V", ("E", "u")), ("V", ("H", "u")), ("V", ("Z", "u")), ("V", ("V", "d")),
    ("Z", ("V", "a")), ("Z", ("Z", "d")), ("S", ("E",)), ("S", ("Z",)),
)
NEXT_ROLE = {"E": "user", "H": "user", "V": "assistant", "Z": "user"}
AFTER = {"s": "H", "u": "V", "a": "Z"}
WAITING = {x: [k for k, (_, body) in enumerate(RULES) if body[0] == x] for x in "EHVZ"}
SPACE = "[\\x20\\x09-\\x0D]"

Best = tuple[int, str]
Column_ = dict[tuple[int, int], Best]


def _relax(column: Column_, item: tuple[int, int], value: Best) -> bool:
    if item not in column or value < column[item]:
        column[item] = value
        return True
    return False


def _close(column: Column_) -> None:
    """Complete finished constituents and insert roles until nothing gets cheaper."""
    agenda = list(column)
    while agenda:
        rule, dot = item = agenda.pop()
        head, body = RULES[rule]
        cost, audit = column[item]
        if dot == len(body):
            reached, value = [(k, 1) for k in WAITING.get(head, ())], (cost, audit)
        elif body[dot] in "ua":
            reached, value = [(rule, dot + 1)], (cost + INSERT, audit + "I")
        else:
            continue
        agenda += [x for x in reached if _relax(column, x, value)]


def _scan(column: Column_, initial: str, unusable: bool, truncated: bool) -> Column_:
    after: Column_ = {}
    extra = TRUNCATED if truncated else 0
    for (rule, dot), (cost, audit) in column.items():
        body = RULES[rule][1]
        if dot == len(body):
            continue
        want = body[dot]
        if want == "d":
            _relax(after, (rule, dot + 1), (cost + DELETE, audit + "D"))
        elif unusable:
            continue
        elif want == initial:
            _relax(after, (rule, dot + 1), (cost + extra, audit + "K"))
        elif want != "s":
            _relax(after, (rule, dot + 1), (cost + extra + REROLE, audit + "R"))
    return after


def parse(rows: list[tuple[str, bool, bool]], entry: str = "E") -> dict[str, Best]:
    """Constituents that can end after ``rows`` of (initial, to be deleted, truncated) if ``entry`` stood before, each at its least."""
    column: Column_ = {(k, 1): (0, "") for k in WAITING[entry]}
    _close(column)
    for row in rows:
        column = _scan(column, *row)
        _close(column)
    ends: dict[str, Best] = {} if rows else {entry: (0, "")}
    for (rule, dot), value in column.items():
        head, body = RULES[rule]
        if dot == len(body) and head != "S" and (head not in ends or value < ends[head]):
            ends[head] = value
    return ends


@lru_cache(8192)
def _short_parse(rows: tuple, entry: str) -> dict[str, Best]:
    return parse(list(rows), entry)


def parsed(rows: list, entry: str) -> dict[str, Best]:
    """:func:`parse`; short blocks, most of which look alike, are parsed once a worker."""
    return _short_parse(tuple(rows), entry) if len(rows) <= 64 else parse(rows, entry)


BLOCK = pa.schema([
    ("conv_id", pa.int64()), ("block", pa.int64()), ("least_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64()), ("blank", pa.int64()),
    ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("first_initial", pa.string()), ("last_initial", pa.string()),
    ("parses", pa.list_(pa.struct([("entry", pa.string()), ("exit", pa.string()), ("cost", pa.int64()), ("audit", pa.string())]))),
])
FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
BATCH = 256


def _rows(batches, *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(n).to_pylist() for n in names], strict=True)


def _batched(rows: Iterator[dict], schema: pa.Schema):
    out = []
    for row in rows:
        out.append(row)
        if len(out) == BATCH:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


def _block(conv_id, block, rows) -> dict:
    turns, known, symbols, before = 0, [], [], None
    n = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
    for _, _, turn, initial, digest, first, blank, truncated, copies in rows:
        for _ in range(copies):
            if turn is not None:
                turns += not known or turn != known[1]
                known = [known[0] if known else turn, turn]
            # Equal rows of one turn stand side by side; the first of them alone may be the first of its kind.
            again = not first or before == (turn, digest)
            fault = "blank" if blank else "duplicate" if again else "truncated" if truncated else None
            if fault:
                n[fault] += 1
            n["illegal"] += bool(symbols) and not _legal(symbols[-1][0], initial)
            symbols.append((initial, fault in ("blank", "duplicate"), fault == "truncated"))
            before = (turn, digest)
    parses = [
        {"entry": x, "exit": y, "cost": cost, "audit": audit}
        for x in ("E" if block == 0 else "EHVZ") for y, (cost, audit) in parsed(symbols, x).items()
    ]
    return {
        "conv_id": conv_id, "block": block, "least_turn": known[0] if known else None, "last_turn": known[1] if known else None, "turns": turns, **n,
        "first_initial": symbols[0][0] if symbols else None, "last_initial": symbols[-1][0] if symbols else None, "parses": parses,
    }


def _parse_blocks(batches):
    rows = _rows(batches, "conv_id", "block", "turn", "initial", "digest", "first", "blank", "truncated", "copies")
    return _batched((_block(*key, group) for key, group in groupby(rows, lambda r: r[:2])), BLOCK)


REPAIR = pa.schema([("conv_id", pa.int64()), *[(f, pa.int64()) for f in FIGURES], ("audit", pa.string())])


def _conversation(conv_id, blocks) -> dict:
    best: dict[str, Best] = {"E": (0, "")}
    total = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    least = last = initial = None
    turns = 0
    for _, lo, hi, n, *counts, first, end, parses in blocks:
        for name, k in zip(total, counts, strict=True):
            total[name] += k
        turns += n
        least = lo if least is None else least
        last = hi if hi is not None else last
        if first is not None:
            total["illegal"] += initial is not None and not _legal(initial, first)
            initial = end
        reached: dict[str, Best] = {}
        for p in parses:
            if p["entry"] in best:
                cost, audit = best[p["entry"]]
                value = (cost + p["cost"], audit + p["audit"])
                if p["exit"] not in reached or value < reached[p["exit"]]:
                    reached[p["exit"]] = value
        best = reached
    cost, audit = min(best[x] for x in "EZ" if x in best)
    return {"conv_id": conv_id, "gaps": 0 if least is None else last - least + 1 - turns, **total, "cost": cost, "audit": audit}


def _join_blocks(batches):
    names = ("conv_id", "least_turn", "last_turn", "turns", "blank", "duplicate", "truncated", "illegal", "first_initial", "last_initial", "parses")
    return _batched((_conversation(key, group) for key, group in groupby(_rows(batches, *names), lambda r: r[0])), REPAIR)


def repaired_rows(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The (role, text) that an audit makes of ``rows``, one after another."""
    state = "E"
    rows = iter(rows)
    for edit in audit:
        if edit != "I":
            role, text = next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = NEXT_ROLE[state]
        yield role, "" if edit == "I" else text
        state = AFTER[role[:1]]


REPAIRED = pa.schema([*REPAIR, ("repaired_sha256", pa.string())])


def _copied(rows) -> Iterator[tuple[str, str]]:
    for role, text, copies in rows:
        for _ in range(copies):
            yield role, text


def _hash_repairs(batches):
    def run():
        names = (*REPAIR.names, "role", "text", "copies")
        for _, group in groupby(_rows(batches, *names), lambda r: r[0]):
            head = next(group)
            digest, started = hashlib.sha256(), False
            for role, text in repaired_rows(head[7], _copied(r[8:] for r in group)):
                digest.update((("\n" if started else "") + f"{role}:{text}").encode())
                started = True
            yield dict(zip(REPAIR.names, head, strict=False)) | {"repaired_sha256": digest.hexdigest()}

    return _batched(run(), REPAIRED)


def _sql(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.string(): "string"}
    return ", ".join(f"{f.name} {names.get(f.type, 'array<struct<entry: string, exit: string, cost: long, audit: string>>')}" for f in schema)


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, copies): counts of faults, cheapest repair, its audit and hash.

    ``copies`` says how often a row stands there; 0 keeps the conversation but not the row.
    """
    digest = F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256)
    rows = rows.select("conv_id", "turn", "role", "text", "copies", digest.alias("digest"))
    turn_key = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = rows.filter("copies > 0").groupBy("conv_id", "digest").agg(F.min(turn_key).alias("t")).select(F.col("conv_id").alias("c"), F.col("digest").alias("g"), F.col("t.turn").alias("t"), F.lit(True).alias("first"))
    blank = ~F.col("text").rlike(SPACE.replace("[", "[^"))
    truncated = ~F.col("text").rlike(f"[.!?]{SPACE}*\\z")
    block = F.coalesce(F.floor(F.greatest(F.col("turn"), F.lit(0)) / BLOCK_TURNS), F.lit(0))
    thin = rows.select("conv_id", block.alias("block"), "turn", "role", F.substring("role", 1, 1).alias("initial"), "digest", blank.alias("blank"), truncated.alias("truncated"), "copies")
    # A row is the first of its kind if it has that kind's least turn; the key holds the turn, so that no kind is a hot key.
    thin = thin.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("g")) & F.col("turn").eqNullSafe(F.col("t")), "left").drop("c", "g", "t").withColumn("first", F.coalesce("first", F.lit(False)))
    order = [F.col("turn").asc_nulls_first(), "role", "digest"]
    blocks = thin.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", *order).drop("role").mapInArrow(_parse_blocks, _sql(BLOCK))
    repairs = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(_join_blocks, _sql(REPAIR))
    heads = repairs.withColumn("kind", F.lit(0))
    bodies = rows.filter("copies > 0").withColumn("kind", F.lit(1))
    stream = heads.unionByName(bodies, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *order)
    return stream.select(*REPAIR.names, "role", "text", "copies").mapInArrow(_hash_repairs, _sql(REPAIRED))


def damaged(rows: DataFrame) -> DataFrame:
    """The query's damage: a fifth of the rows dropped, emptied, cut short, repeated or given to the user."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat(space("conv_id"), F.lit(":"), space("turn")), "UTF-8")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.when(kind == 4, "user").otherwise(space("role")).alias("role"),
        text.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def op11_conversation_repair(spark, sf_dir):
    return repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
