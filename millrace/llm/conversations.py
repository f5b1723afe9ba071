"""Repair of the structure of conversations at least cost, by a Viterbi search that runs in parallel over chunks of turns.

A conversation should be nothing, or an optional system turn and then pairs of a user's and an assistant's turn. Turns are kept
(K, free), given the role user or assistant (R, 2), deleted (D, 3), and empty turns of either role are inserted (I, 2). Blank
turns and repeats of an earlier turn have to go; a turn that breaks off and stays costs 1 more. Of the cheapest repairs the one
whose letters come first in ASCII order is taken.

What has been said so far is one of four states, so the costs to the end are a vector of four numbers at each turn, and the
search runs from the last turn to the first; the letters are then found from the first to the last by following states whose
costs add up, the least letter first.

* Turns are dealt by ranges of (conversation, turn), which spreads a conversation of any length. Nearly all conversations lie
  whole in one batch of one task and are repaired there. The others become chunks of bounded size.
* **Backward.** Every chunk starts from the vector that holds at the end of a conversation; for all but the last chunk that is
  a guess. Then each chunk compares the vector that its right neighbour really hands on with the one it started from. Where
  they differ by more than a constant it reruns, step by step beside the old vector, until the two differ by a constant only:
  from there on all is as before but for the constant. Passes repeat until no chunk has to rerun.
* **Forward.** Stitched together, these costs are exact at every border. Each chunk follows the letters from a guessed state,
  and again the passes repeat until each begins where its left neighbour ended. Chunks of turns that all have to go leave
  vectors and states as they are, so they are left out of the chain.

Vectors usually differ by a constant after a few turns, so a second pass is the last but one. Where they never do (say, a
million system turns in a row) passes go on from chunk to chunk. Repeats across chunks, jumps of role and turn at borders,
counts and costs come from aggregates on narrow tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.components import Steps

CHUNK_ROWS = 4096
CHUNK_BYTES = 4 << 20

# Codes of a turn: its initial (0 to 3), 4 more if it breaks off, 8 more if it is blank. GONE stands for a turn that has to go.
INITIALS = "sua"
TRUNCATED, BLANK, GONE = 4, 8, 16
LEGAL = {(0, 1), (1, 2), (2, 1)}

# States: nothing yet, a system turn, a user's turn last, an assistant's turn last. ADDED is where one more turn of the only
# role that may follow leads to; KEPT, by initial, where a turn leads that stays as it is.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ADDED = [USER, USER, ASSISTANT, USER]
KEPT = [[SYSTEM, None, None, None], [USER, USER, None, USER], [None, None, ASSISTANT, None], [None] * 4]
ROLE = {USER: "user", ASSISTANT: "assistant"}
KEEP, REROLE, DELETE, INSERT, BREAK = 0, 2, 3, 2, 1
# At the end: the cost of what is missing, and how many turns.
END = (0, 4, 2, 0)
MISSING = [0, 2, 1, 0]

_WHITE = " \t\n\x0b\x0c\r"


def _options(code: int, state: int) -> list[tuple[str, int, int]]:
    """What may be done with a turn: letter, cost and next state, in ASCII order of the letters."""
    more = BREAK if code & TRUNCATED else 0
    kept = KEPT[code & 3][state]
    found = [("D", DELETE, state)] + ([("K", KEEP + more, kept)] if kept is not None else [])
    return [*found, ("R", REROLE + more, ADDED[state])]


@cache
def back(vector: tuple[int, ...], code: int) -> tuple[tuple[int, ...], int]:
    """The costs before a turn, given those after it: less the last of them, and that last one."""
    if code == GONE:
        return vector, DELETE
    costs = [min(cost + vector[to] for _, cost, to in _options(code, state)) for state in range(4)]
    user, assistant = min(costs[USER], INSERT + costs[ASSISTANT]), min(costs[ASSISTANT], INSERT + costs[USER])
    whole = (min(costs[NOTHING], INSERT + user), min(costs[SYSTEM], INSERT + user), user, assistant)
    return tuple(c - assistant for c in whole), assistant


@cache
def ahead(vector: tuple[int, ...], code: int, state: int) -> tuple[str, int]:
    """The least letters from a state up to and with a turn, and the state after it; ``vector`` holds after the turn."""
    if code == GONE:
        return "D", state
    before, shift = back(vector, code)
    letters = ""
    while True:
        for letter, cost, to in _options(code, state):
            if letter > "I" and before[state] == INSERT + before[ADDED[state]]:
                break
            if before[state] + shift == cost + vector[to]:
                return letters + letter, to
        letters, state = letters + "I", ADDED[state]


def run_back(codes: bytes, vector: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """The vector before some turns, and the constant that came off it."""
    total = 0
    for code in reversed(codes):
        vector, shift = back(vector, code)
        total += shift
    return vector, total


def rerun_back(codes: bytes, old: tuple, new: tuple, out: tuple, total: int) -> tuple[tuple[int, ...], int]:
    """As ``run_back`` from ``new``, knowing that ``old`` gave ``out`` and ``total``: only until both are the same vector."""
    shifted = 0
    for code in reversed(codes):
        if old == new:
            return out, total + shifted
        (old, was), (new, now) = back(old, code), back(new, code)
        shifted += now - was
    return new, total + shifted


def run_ahead(codes: bytes, vector: tuple[int, ...], state: int) -> tuple[list[str], int]:
    """The letters for each of some turns, from ``state``, and the state after them; ``vector`` holds after them."""
    vectors = [vector]
    for code in reversed(codes):
        vectors.append(back(vectors[-1], code)[0])
    letters = []
    for code, after in zip(codes, reversed(vectors[:-1]), strict=True):
        some, state = ahead(after, code, state)
        letters.append(some)
    return letters, state


def replay(letters: str, codes: bytes, state: int) -> list[tuple[str, int | None, str | None]]:
    """The turns that a repair leaves: letter, number of the turn it was (None for a new one), its new role (None if it keeps its own)."""
    out, row = [], 0
    for letter in letters:
        if letter != "D":
            state = KEPT[codes[row] & 3][state] if letter == "K" else ADDED[state]
            out.append((letter, None if letter == "I" else row, None if letter == "K" else ROLE[state]))
        row += letter != "I"
    return out


def _prepared(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    said, by = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (text, role))
    picked = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), by.alias("role"), said.alias("text"))
    ended = F.rtrim("text", F.lit(_WHITE))
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    closed = ended.endswith(".") | ended.endswith("!") | ended.endswith("?")
    code = initial + F.when(ended == "", BLANK).when(~closed, TRUNCATED).otherwise(0)
    same = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    return picked.withColumns({"code": code.cast("byte"), "same": same})


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
TURNS = "array<struct<edit:string,role:string,text:string>>"
CHUNK = "turn array<long>, code binary, same array<binary>, role array<string>, text array<string>"


def _faults(codes: bytes, repeats: list[bool]) -> tuple[bytes, int, int, int, int]:
    """Codes with GONE for what has to go; how many are blank, repeats, broken off; how many illegal neighbours."""
    blank = sum(c >= BLANK for c in codes)
    again = sum(r and c < BLANK for c, r in zip(codes, repeats, strict=True))
    marked = bytes(GONE if c >= BLANK or r else c for c, r in zip(codes, repeats, strict=True))
    broken = sum(c != GONE and bool(c & TRUNCATED) for c in marked)
    illegal = sum((x & 3, y & 3) not in LEGAL for x, y in zip(codes, codes[1:], strict=False))
    return marked, blank, again, broken, illegal


def _repeats(same: list[bytes]) -> list[bool]:
    seen: set[bytes] = set()
    return [s in seen or bool(seen.add(s)) for s in same]


def _cuts(batch: pa.RecordBatch, rows: int, size: int) -> tuple[list[int], list[bool]]:
    """Where chunks begin (and the end), and which of them are whole conversations that touch neither end of the batch."""
    conv = batch.column("conv").dictionary_encode().indices.fill_null(-1).to_pylist()
    lengths, n = pc.binary_length(batch.column("text")).to_pylist(), len(conv)
    begins, used = [0], 0
    for i in range(1, n):
        used += lengths[i - 1]
        if conv[i] != conv[i - 1] or i - begins[-1] >= rows or used + lengths[i] > size:
            begins.append(i)
            used = 0
    whole = [a > 0 and b < n and conv[a - 1] != conv[a] and conv[b] != conv[b - 1] for a, b in zip(begins, [*begins[1:], n], strict=True)]
    return [*begins, n], whole


def _dealt(rows: int, size: int):
    """Sorted turns to whole conversations, repaired, and chunks of the others."""

    def batches(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 33
        for batch in incoming:
            if not len(batch):
                continue
            cuts, whole = _cuts(batch, rows, size)
            turn, code, same = (batch.column(c).to_pylist() for c in ("turn", "code", "same"))
            reports, chunks, kept, roles, edits, counts = [], [], [], [], [], [0]
            for a, b, complete in zip(cuts, cuts[1:], whole, strict=False):
                codes = bytes(code[a:b])
                if complete:
                    marked, *counted = _faults(codes, _repeats(same[a:b]))
                    vector, cost = run_back(marked, END)
                    letters, state = run_ahead(marked, END, NOTHING)
                    audit = "".join(letters) + "I" * MISSING[state]
                    numbers = {t for t in turn[a:b] if t is not None}
                    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
                    reports.append((gaps, *counted, cost + vector[NOTHING], audit))
                    chunks.append(None)
                    for edit, row, role in replay(audit, marked, NOTHING):
                        edits.append(edit)
                        kept.append(None if row is None else a + row)
                        roles.append(a + row if role is None else len(batch) + (role == ROLE[ASSISTANT]))
                else:
                    reports.append(None)
                    chunks.append((turn[a:b], codes, same[a:b], *(batch.column(c).slice(a, b - a).to_pylist() for c in ("role", "text"))))
                counts.append(len(edits))
            every = pa.concat_arrays([batch.column("role"), pa.array([ROLE[USER], ROLE[ASSISTANT]], batch.column("role").type)])
            repaired = pa.StructArray.from_arrays(
                [pa.array(edits, pa.string()), every.take(pa.array(roles, pa.int64())),
                 batch.column("text").take(pa.array(kept, pa.int64())).fill_null("")], ["edit", "role", "text"],
            )
            numbered = pa.array(range(at, at + len(whole)), pa.int64())
            at += len(whole)
            columns = {"conv": batch.column("conv").take(pa.array(cuts[:-1], pa.int64())), "at": numbered, "whole": pa.array(whole, pa.bool_())}
            kinds = [pa.int64()] * 6 + [pa.string()]
            for i, (name, kind) in enumerate(zip(_names(REPORT), kinds, strict=True)):
                columns[name] = pa.array([r and r[i] for r in reports], kind)
            columns["turns"] = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), repaired)
            kinds = [pa.list_(pa.int64()), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.string()), pa.list_(pa.string())]
            for i, (name, kind) in enumerate(zip(_names(CHUNK), kinds, strict=True)):
                columns[name] = pa.array([c and c[i] for c in chunks], kind)
            yield pa.RecordBatch.from_pydict(columns)

    return batches


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _by_row(function, names: list[str], types: list[pa.DataType], keys=("conv", "at")):
    """A function of a row's values (dict to tuple) as one of Arrow batches; the key columns stay."""

    def batches(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            values = batch.select([c for c in batch.schema.names if c != "conv"]).to_pylist()
            made = [function(v) for v in values]
            columns = [pa.array([m[i] for m in made], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), *columns], [*keys, *names])

    return batches


def _same_conv(left: DataFrame, right: DataFrame, *on: str, how: str = "inner") -> DataFrame:
    """A join on the conversation, null too, and more columns."""
    right = right.withColumnsRenamed({"conv": "conv_2", **{c: f"{c}_2" for c in on}})
    equal = F.col("conv").eqNullSafe(F.col("conv_2"))
    for c in on:
        equal &= F.col(c) == F.col(f"{c}_2")
    return left.join(right, equal, how).drop("conv_2", *(f"{c}_2" for c in on))


def _marked(chunks: DataFrame, kind: str) -> DataFrame:
    """Chunks with their faults counted and GONE in their codes; repeats are found over all chunks of a conversation."""
    each = chunks.select("conv", "at", F.posexplode("same").alias("pos", "same"))
    first = each.groupBy("conv", "same").agg(F.min(F.struct("at", "pos")).alias("first")).select("conv", "first.*")
    firsts = first.groupBy("conv", "at").agg(F.collect_list("pos").alias("firsts"))

    def mark(chunk: dict) -> tuple:
        fresh = set(chunk["firsts"] or ())
        codes = chunk["code"]
        marked, blank, again, broken, illegal = _faults(codes, [i not in fresh for i in range(len(codes))])
        turns = [t for t in chunk["turn"] if t is not None]
        span = (turns[0], turns[-1], len(set(turns))) if turns else (None, None, 0)
        return marked, blank, again, broken, illegal, codes[0] & 3, codes[-1] & 3, *span

    names = "code blank duplicate truncated illegal head tail lowest highest numbers".split()
    types = [pa.binary(), *[pa.int64()] * 9]
    schema = f"conv {kind}, at long, code binary, " + ", ".join(f"{n} long" for n in names[1:])
    joined = _same_conv(chunks.select("conv", "at", "turn", "code"), firsts, "at", how="left")
    return joined.select("conv", "at", "turn", "code", "firsts").mapInArrow(_by_row(mark, names, types), schema)


_VECTOR = pa.list_(pa.int64())


def _backward(chain: DataFrame, kind: str, steps: Steps) -> DataFrame:
    """The chain (conv, no, at, code, last) with the vector that each chunk gets, the one it hands on and the constant."""
    schema = f"conv {kind}, at long, no long, last boolean, code binary, given array<long>, handed array<long>, total long"
    names, types = _names(schema)[2:], [pa.int64(), pa.bool_(), pa.binary(), _VECTOR, _VECTOR, pa.int64()]

    def guess(c: dict) -> tuple:
        vector, total = run_back(c["code"], END)
        return c["no"], c["last"], c["code"], END, vector, total

    def again(c: dict) -> tuple:
        given, handed = tuple(c["given"]), tuple(c["handed"])
        new = tuple(c["arrived"]) if c["arrived"] else given
        handed, total = rerun_back(c["code"], given, new, handed, c["total"])
        return c["no"], c["last"], c["code"], new, handed, total

    done = steps.keep(chain.mapInArrow(_by_row(guess, names, types), schema))
    while True:
        arriving = done.filter("no > 1").select("conv", (F.col("no") - 1).alias("no"), F.col("handed").alias("arrived"))
        meeting = _same_conv(done, arriving, "no", how="left")
        if meeting.filter("arrived <> given").isEmpty():
            return done
        done = steps.keep(meeting.mapInArrow(_by_row(again, names, types), schema))


def _forward(chain: DataFrame, kind: str, steps: Steps) -> DataFrame:
    """The chain with the state that each chunk begins in, its letters, and the state it ends in."""
    schema = f"conv {kind}, at long, no long, last boolean, code binary, given array<long>, begun long, audit string, ended long"
    names = _names(schema)[2:]
    types = [pa.int64(), pa.bool_(), pa.binary(), _VECTOR, pa.int64(), pa.string(), pa.int64()]

    def follow(c: dict, state: int) -> tuple:
        letters, ended = run_ahead(c["code"], tuple(c["given"]), state)
        return c["no"], c["last"], c["code"], c["given"], state, "".join(letters), ended

    def guess(c: dict) -> tuple:
        return follow(c, NOTHING if c["no"] == 1 else ASSISTANT)

    def again(c: dict) -> tuple:
        if c["arrived"] is None or c["arrived"] == c["begun"]:
            return tuple(c[n] for n in names)
        return follow(c, c["arrived"])

    done = steps.keep(chain.mapInArrow(_by_row(guess, names, types), schema))
    while True:
        arriving = done.filter("NOT last").select("conv", (F.col("no") + 1).alias("no"), F.col("ended").alias("arrived"))
        meeting = _same_conv(done, arriving, "no", how="left")
        if meeting.filter("arrived <> begun").isEmpty():
            return done
        done = steps.keep(meeting.mapInArrow(_by_row(again, names, types), schema))


class Repair:
    """The repair of a table of turns, in any order.

    ``report`` has a row for each conversation: conv (its id), gaps (numbers missing between its lowest and highest turn), blank,
    duplicate and truncated (turns by their first fault), illegal (neighbours whose initials are not su, ua or au), cost and audit
    (the letters of the edits in order). ``pieces`` holds what is left of it: conv, at (their order) and turns (letter, role, text).

    Turns go by their number, null first; turns of the same number by a digest of role and text, so repeated rows stand side
    by side. Null roles and texts are one space. A null id is a conversation of its own. An empty table gives none.
    """

    def __init__(
        self, rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
        chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES,
    ):
        steps = Steps(rows.sparkSession, "conversations")
        prepared = _prepared(rows, conv, turn, role, text)
        kind = prepared.schema["conv"].dataType.simpleString()
        order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("same")]
        sorted_turns = prepared.repartitionByRange(*order).sortWithinPartitions(*order)
        schema = f"conv {kind}, at long, whole boolean, {REPORT}, turns {TURNS}, {CHUNK}"
        dealt = steps.keep(sorted_turns.mapInArrow(_dealt(chunk_rows, chunk_bytes), schema))
        done, chunks = dealt.filter("whole"), dealt.filter("NOT whole")

        marked = steps.keep(_marked(chunks, kind))
        number = W.partitionBy("conv").orderBy("at")
        open_turns = F.length(F.translate(F.decode("code", "ISO-8859-1"), chr(GONE), "")) > 0
        chained = marked.filter(open_turns).select(
            "conv", "at", "code", F.row_number().over(number).cast("long").alias("no"), F.lead("at").over(number).isNull().alias("last")
        )
        back_done = _backward(chained, kind, steps)
        ahead_done = _forward(back_done.select("conv", "at", "no", "last", "code", "given"), kind, steps)

        gone = F.length("code")
        letters = _same_conv(marked, ahead_done.select("conv", "at", "audit", "begun", "ended", "last"), "at", how="left")
        letters = _same_conv(letters, back_done.select("conv", "at", "handed", "total", "no"), "at", how="left")
        start = F.when(F.col("no") == 1, F.element_at("handed", NOTHING + 1)).otherwise(0)
        jump = F.struct("head", F.lag("tail").over(number).alias("before"))
        legal = F.array(*[F.struct(F.lit(y).cast("long").alias("head"), F.lit(x).cast("long").alias("before")) for x, y in sorted(LEGAL)])
        again = F.col("lowest") == F.lag("highest").over(number)
        letters = steps.keep(
            letters.select(
                "conv", "at", "blank", "duplicate", "truncated", "lowest", "highest",
                F.coalesce("audit", F.repeat(F.lit("D"), gone)).alias("audit"), F.coalesce("begun", F.lit(NOTHING)).alias("begun"),
                F.coalesce(F.col("total") + start, DELETE * gone).alias("cost"),
                F.when(F.col("last"), F.element_at(F.array(*map(F.lit, MISSING)), (F.col("ended") + 1).cast("int"))).alias("missing"),
                F.when(F.col("last"), F.col("ended")).alias("ended"),
                (F.col("illegal") + F.when(jump["before"].isNotNull() & ~F.array_contains(legal, jump), 1).otherwise(0)).alias("illegal"),
                (F.col("numbers") - F.when(again, 1).otherwise(0)).alias("numbers"),
            )
        )
        parts = F.transform(F.sort_array(F.collect_list(F.struct("at", "audit"))), lambda p: p["audit"])
        total = letters.groupBy("conv").agg(
            F.coalesce(F.max("highest") - F.min("lowest") + 1 - F.sum("numbers"), F.lit(0)).alias("gaps"),
            *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")),
            F.concat(F.array_join(parts, ""), F.repeat(F.lit("I"), F.coalesce(F.max("missing"), F.lit(0)))).alias("audit"),
        )
        self.report = done.select("conv", *_names(REPORT)).unionByName(total)

        def repaired(chunk: dict) -> tuple:
            turns = replay(chunk["audit"], chunk["code"], chunk["begun"])
            return ([
                {"edit": edit, "role": role or chunk["role"][row], "text": "" if row is None else chunk["text"][row]} for edit, row, role in turns
            ],)

        turn_type = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))
        replayed = _same_conv(chunks.select("conv", "at", "code", "role", "text"), letters.select("conv", "at", "audit", "begun"), "at")
        pieces = replayed.mapInArrow(_by_row(repaired, ["turns"], [turn_type]), f"conv {kind}, at long, turns {TURNS}")
        added = F.when(F.col("ended") == USER, F.array(F.lit(ROLE[ASSISTANT]))).otherwise(F.array(F.lit(ROLE[USER]), F.lit(ROLE[ASSISTANT])))
        new = F.transform(added, lambda role: F.struct(F.lit("I").alias("edit"), role.alias("role"), F.lit("").alias("text")))
        closing = letters.groupBy("conv").agg((F.max("at") + 1).alias("at"), F.max("missing").alias("missing"), F.max("ended").alias("ended"))
        closing = closing.filter("missing > 0").select("conv", F.col("at"), new.cast(TURNS).alias("turns"))
        self.kind, self.steps = kind, steps
        self._whole, self._cut = done.select("conv", "at", "turns"), steps.keep(pieces.unionAll(closing))

    @property
    def pieces(self) -> DataFrame:
        return self._whole.unionAll(self._cut)

    def text_digests(self) -> DataFrame:
        """conv and the SHA-256 (hex) of its repaired turns, each as role, colon and text, joined by new lines.

        Conversations that lie whole in a row are hashed there. The pieces of one that does not go through a single task in their
        order, because this digest can be made in no other way; the task holds some pieces at a time.
        """

        def line(turn: Column) -> Column:
            return F.concat(turn["role"], F.lit(":"), turn["text"])

        joined = F.array_join(F.transform("turns", line), "\n")
        whole = self._whole.select("conv", F.sha2(joined, 256).alias("digest"))
        cut = self._cut.select("conv", "at", F.when(F.size("turns") > 0, joined).alias("lines"))
        order = [F.col("conv").asc_nulls_first(), F.col("at")]
        cut = cut.repartition("conv").sortWithinPartitions(*order)
        return whole.unionAll(cut.mapInArrow(_stream_digests, f"conv {self.kind}, digest string"))


def _stream_digests(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, running, lines = None, None, 0
    for batch in incoming:
        found = []
        for i, text in enumerate(batch.column("lines").to_pylist()):
            own = batch.column("conv").slice(i, 1)
            if running is None or not own.equals(conv):
                if running is not None:
                    found.append((conv, running.hexdigest()))
                conv, running, lines = own, hashlib.sha256(), 0
            if text is not None:
                running.update(b"\n" * bool(lines) + text.encode())
                lines += 1
        if found:
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([c for c, _ in found]), pa.array([d for _, d in found])], ["conv", "digest"])
    if running is not None:
        yield pa.RecordBatch.from_arrays([conv, pa.array([running.hexdigest()])], ["conv", "digest"])
