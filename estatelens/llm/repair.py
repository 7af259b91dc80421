"""Repair of conversation structure: bidirectional Dijkstra over the edit lattice.

A node of the lattice is (rows read, state); the states are those of the
grammar ``(s?(ua)+)?`` over role initials: nothing yet, after the system row,
after a user row, after an assistant row. Edges are the edits Keep, Rerole,
Delete and Insert. ``search`` grows a forward and a reverse heap from both
ends until their tops together cost more than the best crossing, so that every
crossing of that cost is known, and takes the least concatenated audit.

An audit and the state it starts in fix the state it ends in and its cost, and
a longer audit over the same rows costs more. So of two audits of one cost
between the same two nodes neither begins the other, and the least audit of a
path is made of the least audits of its parts. That is what lets the search
keep one audit a node, and what lets a long conversation be cut.

Rows are range-partitioned by conversation and turn, so a conversation of any
length is spread over tasks. A task repairs the conversations that lie inside
its range; of those that reach over its ends, or have more than
``SEGMENT_ROWS`` rows, it returns segments: the cheapest audit between every
two states. The segments (a small part of the rows) are folded in order, and
one more pass over these conversations' rows applies the audits. A digest of a
whole conversation is sequential by nature; that pass streams.

Defined results: null role or text is one space; null turn comes first; a null
conversation id is a conversation of its own; rows of one turn go by role, then
by the digest of their text, and rows equal in all are interchangeable; without
rows all counts are zero and the audit is empty.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estatelens.llm.common import prepare, scratch

BLANK = r"[^\x20\x09-\x0D]"
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 2, 3, 2, 1
#: State after a kept row, by state and role initial. States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
#: State after the one row that Rerole or Insert can add in each state, and the states before.
ADDED = (2, 2, 3, 2)
BEFORE = {2: (0, 1, 3), 3: (2,)}
NAMES = {2: "user", 3: "assistant"}
ACCEPTED = (0, 3)
LEGAL = ("su", "ua", "au")
#: Longer conversations are cut into segments of so many rows.
SEGMENT_ROWS = 256
SEGMENT_CHARS = 4_000_000

Row = tuple[str, bool, int]                    # role initial, must go, cost of staying truncated


def search(rows: list[Row], sources: tuple[int, ...] = (0,), targets: tuple[int, ...] = ACCEPTED) -> tuple[int, str] | None:
    """Cost and least audit of the cheapest edits from one of the states before the rows to one of those after them."""
    end = len(rows)
    ahead = {(0, q): (0, "") for q in sources}
    back = {(end, q): (0, "") for q in targets}
    up, down = [(0, 0, q) for q in sources], [(0, -end, q) for q in targets]
    heapq.heapify(up), heapq.heapify(down)
    done_up, done_down = set(), set()
    best = None

    def meet(node: tuple[int, int]) -> None:
        nonlocal best
        if node in ahead and node in back:
            cost = ahead[node][0] + back[node][0]
            if best is None or cost < best:
                best = cost

    def relax(labels: dict, heap: list, node: tuple[int, int], label: tuple[int, str], sign: int) -> None:
        old = labels.get(node)
        if old is None or label < old:
            labels[node] = label
            if old is None or label[0] < old[0]:
                heapq.heappush(heap, (label[0], sign * node[0], node[1]))
                meet(node)

    for node in list(ahead):
        meet(node)
    while up and down and (best is None or up[0][0] + down[0][0] <= best):
        # at equal cost only Keep joins nodes, so these settle in the order of the rows
        if (up[0][0], len(up)) <= (down[0][0], len(down)):
            _, i, q = heapq.heappop(up)
            if (i, q) in done_up:
                continue
            done_up.add((i, q))
            cost, audit = ahead[i, q]
            relax(ahead, up, (i, ADDED[q]), (cost + INSERT_COST, audit + "I"), 1)
            if i < end:
                initial, gone, cut = rows[i]
                relax(ahead, up, (i + 1, q), (cost + DELETE_COST, audit + "D"), 1)
                if not gone:
                    relax(ahead, up, (i + 1, ADDED[q]), (cost + REROLE_COST + cut, audit + "R"), 1)
                    if (q, initial) in KEPT:
                        relax(ahead, up, (i + 1, KEPT[q, initial]), (cost + KEEP_COST + cut, audit + "K"), 1)
        else:
            _, i, q = heapq.heappop(down)
            i = -i
            if (i, q) in done_down:
                continue
            done_down.add((i, q))
            cost, audit = back[i, q]
            for p in BEFORE.get(q, ()):
                relax(back, down, (i, p), (cost + INSERT_COST, "I" + audit), -1)
            if i:
                initial, gone, cut = rows[i - 1]
                relax(back, down, (i - 1, q), (cost + DELETE_COST, "D" + audit), -1)
                if not gone:
                    for p in BEFORE.get(q, ()):
                        relax(back, down, (i - 1, p), (cost + REROLE_COST + cut, "R" + audit), -1)
                    for p in range(4):
                        if KEPT.get((p, initial)) == q:
                            relax(back, down, (i - 1, p), (cost + KEEP_COST + cut, "K" + audit), -1)
    if best is None:
        return None
    return best, min(a + back[n][1] for n, (c, a) in ahead.items() if n in back and c + back[n][0] == best)


def paths(rows: list[Row]) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, least audit) of a segment, for every two states that edits join."""
    found = [(p, q, search(rows, (p,), (q,))) for p in range(4) for q in range(4) if not (q < p and q < 2)]
    return [(p, q, *f) for p, q, f in found if f]


def follow(best: dict[int, tuple[int, str]], segment: list[tuple[int, int, int, str]]) -> dict[int, tuple[int, str]]:
    """The cheapest audits up to a segment's end, from those up to its begin."""
    out: dict[int, tuple[int, str]] = {}
    for p, q, cost, audit in segment:
        if p in best:
            label = (best[p][0] + cost, best[p][1] + audit)
            out[q] = min(out.get(q, label), label)
    return out


def rewrite(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """Role and text of every row that an audit leaves; ``rows`` are read as far as the audit needs them."""
    state = 0
    for edit in audit:
        if edit == "I":
            state = ADDED[state]
            yield NAMES[state], ""
            continue
        role, text = next(rows)
        if edit == "K":
            state = KEPT[state, role[:1]]
            yield role, text
        elif edit == "R":
            state = ADDED[state]
            yield NAMES[state], text


class Digest:
    """sha256 of ``role:text`` lines joined by newlines."""

    def __init__(self):
        self.hash, self.lines = hashlib.sha256(), 0

    def add(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1


def damage(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, kept of ``turns`` after seeded faults; a dropped row stays with kept = false, a repeated one comes twice."""
    named = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                        F.pmod(F.crc32(named.cast("binary")), F.lit(20)).alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       (F.col("fault") != 0).alias("kept"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy"))
    return rows.drop("copy")


def faults(turns: DataFrame) -> DataFrame:
    """conv, kept, turn, role, text, mark of every row; mark: 0 sound, 1 blank, 2 repeats an earlier turn, 3 truncated.

    A row that equals its neighbour in turn, role and text gets no mark 2 here;
    that repetition shows in the order. Only pairs (conversation, digest) that
    occur more than once are joined back, so a much repeated text meets one row.
    """
    kept = F.col("kept") if "kept" in turns.columns else F.lit(True)
    ended = F.substring(F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     ")), -1, 1)
    rows = turns.select(F.col("conv_id").alias("conv"), kept.alias("kept"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                        F.coalesce("text", F.lit(" ")).alias("text"))
    rows = rows.select("*", F.sha2("text", 256).alias("sha"), (~F.col("text").rlike(BLANK)).alias("blank"), ended.isin(".", "!", "?").alias("closed"))
    first = (rows.filter("kept and not blank").groupBy("conv", "role", "sha")
             .agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1")
             .select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("sha").alias("s"), F.col("first.turn").alias("first_turn")))
    joined = rows.join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("sha") == F.col("s")), "left")
    later = F.col("s").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first_turn"))
    return joined.select("conv", "kept", "turn", "role", "text", "sha",
                         F.when(F.col("blank"), 1).when(later, 2).when(~F.col("closed"), 3).otherwise(0).alias("mark"))


def _order() -> list[Column]:
    return [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("sha")]


STATS = ("rows bigint, first_turn bigint, last_turn bigint, turns bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
         "first_initial string, last_initial string")
NAMES_OF_STATS = [c.split()[0] for c in STATS.split(", ")]


class Segment:
    """Rows of one conversation in order, with their counts."""

    def __init__(self):
        self.lattice: list[Row] = []
        self.lines: list[tuple[str, str]] = []
        self.chars = self.turns = 0
        self.first_turn = self.last_turn = None
        self.marks = [0, 0, 0, 0]
        self.illegal = 0

    def add(self, turn: int | None, role: str, text: str, mark: int) -> None:
        if turn is not None:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.turns += turn != self.last_turn
            self.last_turn = turn
        initial = role[:1]
        self.illegal += bool(self.lattice) and self.lattice[-1][0] + initial not in LEGAL
        self.marks[mark] += 1
        self.lattice.append((initial, mark in (1, 2), TRUNCATED_COST * (mark == 3)))
        self.lines.append((role, text))
        self.chars += len(text)

    def stats(self) -> list:
        ends = (self.lattice[0][0], self.lattice[-1][0]) if self.lattice else (None, None)
        return [len(self.lattice), self.first_turn, self.last_turn, self.turns, *self.marks[1:], self.illegal, *ends]


def _segments(conv_type: pa.DataType, segment_rows: int):
    """Task over a sorted range: finished conversations, and segments of those that may reach over its ends or are long."""
    schema = pa.schema([("conv", conv_type), ("part", pa.int32()), ("seq", pa.int64()), ("done", pa.bool_())]
                       + [(c, pa.string() if "initial" in c else pa.int64()) for c in NAMES_OF_STATS]
                       + [("cost", pa.int64()), ("audit", pa.string()), ("digest", pa.string()),
                          ("paths", pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, out = TaskContext.get().partitionId(), 0, []

        def close(conv, segment: Segment, whole: bool) -> None:
            nonlocal seq
            cost = audit = digest = found = None
            if whole:
                cost, audit = search(segment.lattice)
                d = Digest()
                for line in rewrite(audit, iter(segment.lines)):
                    d.add(*line)
                digest = d.hash.hexdigest()
            else:
                found = [dict(zip("pq", p[:2]), cost=p[2], audit=p[3]) for p in paths(segment.lattice)]
            out.append(dict(zip(schema.names, [conv, part, seq, whole, *segment.stats(), cost, audit, digest, found])))
            seq += 1

        now, segment, first, cut, before = None, None, True, False, None
        for b in batches:
            for conv, kept, turn, role, text, sha, mark in zip(*[c.to_pylist() for c in b.columns]):
                if segment is None or conv != now:
                    if segment is not None:
                        close(now, segment, not (first or cut))
                        first = False
                    now, segment, cut, before = conv, Segment(), False, None
                if not kept:
                    continue
                if len(segment.lattice) >= segment_rows or segment.chars >= SEGMENT_CHARS:
                    close(now, segment, False)
                    segment, cut = Segment(), True
                if (turn, role, sha) == before and mark != 1:
                    mark = 2
                before = turn, role, sha
                segment.add(turn, role, text, mark)
            if len(out) >= 500:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if segment is not None:
            close(now, segment, False)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    return run, schema


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _gaps(first: Column, last: Column, turns: Column) -> Column:
    return F.coalesce(last - first + 1 - turns, F.lit(0)).cast("long").alias("gaps")


def _fold(conv_type: pa.DataType):
    """Task over sorted segments of whole conversations: counts, cost and audit of each."""
    schema = pa.schema([("conv", conv_type)] + [(c, pa.int64()) for c in COUNTS] + [("audit", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, best, total = None, None, None

        def result() -> pa.RecordBatch:
            cost, audit = min(best[q] for q in ACCEPTED if q in best)
            gaps = total["last"] - total["first"] + 1 - total["turns"] if total["turns"] else 0
            row = [now, gaps, total["blank"], total["duplicate"], total["truncated"], total["illegal"], cost, audit]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, schema.types)], schema=schema)

        for b in batches:
            for r in b.to_pylist():
                if total is None or r["conv"] != now:
                    if total is not None:
                        yield result()
                    now, best = r["conv"], {0: (0, "")}
                    total = dict.fromkeys(("turns", "blank", "duplicate", "truncated", "illegal"), 0) | {"first": None, "last": None, "initial": None}
                if not r["rows"]:
                    continue
                best = follow(best, [(p["p"], p["q"], p["cost"], p["audit"]) for p in r["paths"]])
                for c in ("blank", "duplicate", "truncated", "illegal", "turns"):
                    total[c] += r[c]
                total["turns"] -= r["first_turn"] is not None and r["first_turn"] == total["last"]
                total["illegal"] += total["initial"] is not None and total["initial"] + r["first_initial"] not in LEGAL
                total["first"] = r["first_turn"] if total["first"] is None else total["first"]
                total["last"] = total["last"] if r["last_turn"] is None else r["last_turn"]
                total["initial"] = r["last_initial"]
        if total is not None:
            yield result()
    return run, schema


def _apply(conv_type: pa.DataType, rows_out: bool):
    """Task over sorted rows behind their conversation's audit: the digest of each repaired conversation, or its rows."""
    names = [("place", pa.int64()), ("role", pa.string()), ("text", pa.string())] if rows_out else [("digest", pa.string())]
    schema = pa.schema([("conv", conv_type), *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = ((c, o, k, r, t) for b in batches for c, o, k, r, t in zip(*[x.to_pylist() for x in b.columns]))
        ahead = next(stream, None)
        out, size = [], 0
        while ahead is not None:
            conv, _, _, _, audit = ahead
            ahead = next(stream, None)

            def rows(conv=conv):
                nonlocal ahead
                while ahead is not None and ahead[0] == conv and ahead[1]:
                    row, ahead = ahead, next(stream, None)
                    if row[2]:
                        yield row[3], row[4]
            digest, left = Digest(), rows()
            for place, (role, text) in enumerate(rewrite(audit, left)):
                if rows_out:
                    out.append(dict(zip(schema.names, (conv, place, role, text))))
                    size += len(text)
                    if size >= 4_000_000:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, size = [], 0
                else:
                    digest.add(role, text)
            for _ in left:                               # rows that were dropped before
                pass
            if not rows_out:
                out.append({"conv": conv, "digest": digest.hash.hexdigest()})
            if len(out) >= 500:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    return run, schema


def _sql_type(turns: DataFrame) -> tuple[str, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    kind: T.DataType = turns.schema["conv_id"].dataType
    return kind.simpleString(), to_arrow_type(kind)


def _behind_audits(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """conv, place, kept, role, text: for each conversation its audit, then its rows in order, in one task."""
    c = F.col("conv")
    mine = rows.join(audits.select(c.alias("c")), c.eqNullSafe(F.col("c")), "left_semi")
    both = (audits.select("conv", F.lit(0).alias("place"), F.lit(True).alias("kept"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                          F.col("audit").alias("text"), F.lit("").alias("sha"))
            .unionByName(mine.select("conv", F.lit(1).alias("place"), "kept", "turn", "role", "text", "sha")))
    first, *rest = _order()
    return both.repartition("conv").sortWithinPartitions(first, "place", *rest).select("conv", "place", "kept", "role", "text")


def repair(turns: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation of ``turns``.

    ``turns`` has conv_id, turn, role, text, and may have kept: rows where it
    is false are not there, but their conversation is.
    """
    spark = turns.sparkSession
    prepare(spark)
    sql, arrow = _sql_type(turns)
    rows = faults(turns)
    ranged = rows.repartitionByRange(*_order()).sortWithinPartitions(*_order())
    run, _ = _segments(arrow, segment_rows)
    schema = f"conv {sql}, part int, seq bigint, done boolean, {STATS}, cost bigint, audit string, digest string, paths array<struct<p:int,q:int,cost:bigint,audit:string>>"
    found = scratch(ranged.select("conv", "kept", "turn", "role", "text", "sha", "mark").mapInArrow(run, schema), "repair")
    done = found.filter("done").select("conv", _gaps(F.col("first_turn"), F.col("last_turn"), F.col("turns")), *COUNTS[1:], "audit", "digest")
    fold, _ = _fold(arrow)
    pieces = found.filter("not done").drop("done", "cost", "audit", "digest").repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "part", "seq")
    audits = scratch(pieces.mapInArrow(fold, f"conv {sql}, {', '.join(f'{c} bigint' for c in COUNTS)}, audit string"), "audits")
    digest, _ = _apply(arrow, False)
    digests = _behind_audits(rows, audits).mapInArrow(digest, f"conv {sql}, digest string").select(F.col("conv").alias("c"), "digest")
    late = audits.join(digests, F.col("conv").eqNullSafe(F.col("c"))).select("conv", *COUNTS, "audit", "digest")
    return done.unionByName(late).select(F.col("conv").alias("conv_id"), *COUNTS, "audit", F.col("digest").alias("repaired_sha256"))


def repaired_rows(turns: DataFrame, plan: DataFrame) -> DataFrame:
    """conv_id, place, role, text of the conversations as the audits of ``plan`` (conv_id, audit) leave them."""
    prepare(turns.sparkSession)
    sql, arrow = _sql_type(turns)
    run, _ = _apply(arrow, True)
    audits = plan.select(F.col("conv_id").alias("conv"), "audit")
    return _behind_audits(faults(turns), audits).mapInArrow(run, f"conv {sql}, place bigint, role string, text string").withColumnRenamed("conv", "conv_id")
