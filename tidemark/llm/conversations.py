"""Conversation structure repair: the cheapest edits that give every conversation a legal order.

Rows are taken by turn. A row is a symbol: the class of its role (system, user, assistant, other)
and its fault (none, truncated, one that must go). Equal consecutive symbols are collapsed to runs.
A conversation is a walk over four states (nothing yet, after system, after user, after assistant);
each symbol is a min-plus matrix over them, a run advances by cached binary powers of its matrix,
and the edits are unrolled from the costs that remain. The product of matrices is associative, so a
conversation that spans several ranges of the ordered rows is settled from one matrix per range.

What moves: digests and flags of the rows, range-partitioned by conversation and turn, so that a
conversation with a third of all rows spans many ranges; repeated rows are counted before. The
texts pass one shuffle, to the hash of the repaired conversation, which reads them in order as a
stream: a hash over one text has no parts, so a very long conversation is read by one task there,
in bounded memory but for its audit, which is a value of the result.

Defined results: a null conv_id is a conversation of its own; a null turn comes first; a null role
or text is one space. Rows of equal turn are ordered by role, then by the MD5 of role and text.
Repeated rows are duplicates. A role is what its first character says; other roles are rerole or
delete. Other columns are never read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import small_batches
from tidemark.llm.spread import join_groups
from tidemark.sources.scratch import materialize

# Costs of the edits, the legal pairs of role initials, roles that may be put in.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
LEGAL = ("su", "ua", "au")
WHITE = " \t\n\x0b\x0c\r"

#: States: nothing yet, after system, after user, after assistant. An order may end in the first
#: and the last. Each state has one role that may be put in and one state that follows.
STATES = 4
ENDS = (0, 3)
PUT_IN = ("user", "user", "assistant", "user")
FOLLOWS = (2, 2, 3, 2)
NEVER = 1 << 60

# Symbols: role class + 4 * fault; from MUST_GO on a row can only be deleted.
CLASSES = "sua"
OTHER = 3
NO_FAULT, CUT, MUST_GO = 0, 4, 8

Matrix = tuple[tuple[int, ...], ...]
Vector = tuple[int, ...]


def _times(a: Matrix, b: Matrix) -> Matrix:
    across = tuple(zip(*b, strict=True))
    return tuple(tuple(min(map(int.__add__, row, col)) for col in across) for row in a)


def _onto(a: Matrix, v: Vector) -> Vector:
    return tuple(min(map(int.__add__, row, v)) for row in a)


def _closure() -> Matrix:
    """Costs between states by inserts alone."""
    costs = [[0 if s == t else NEVER for t in range(STATES)] for s in range(STATES)]
    for s in range(STATES):
        at, spent = FOLLOWS[s], INSERT
        while costs[s][at] > spent:
            costs[s][at] = spent
            at, spent = FOLLOWS[at], spent + INSERT
    return tuple(map(tuple, costs))


INSERTS = _closure()
IDENTITY: Matrix = tuple(
    tuple(0 if s == t else NEVER for t in range(STATES)) for s in range(STATES)
)
#: What is left to pay after the last row, by state.
END: Vector = _onto(INSERTS, tuple(0 if s in ENDS else NEVER for s in range(STATES)))


def _kept(state: int, symbol: int) -> int | None:
    """The state after a row of the symbol is kept, None where it may not be."""
    if symbol >= MUST_GO:
        return None
    role = symbol % 4
    if role == 0:
        return 1 if state == 0 else None
    legal = role == 1 and state != 2 or role == 2 and state == 2
    return role + 1 if legal else None


def _choices(state: int, symbol: int) -> list[tuple[str, int, int]]:
    """(letter, cost, state after) of the edits that consume a row."""
    found = [("D", DELETE, state)]
    extra = TRUNCATED if symbol >= CUT else 0
    after = _kept(state, symbol)
    if after is not None:
        found.append(("K", extra, after))
    if symbol < MUST_GO:
        found.append(("R", REROLE + extra, FOLLOWS[state]))
    return found


@lru_cache(maxsize=None)
def power(symbol: int, exponent: int) -> Matrix:
    """The matrix of 2**exponent rows of one symbol, each with the inserts before it."""
    if exponent:
        half = power(symbol, exponent - 1)
        return _times(half, half)
    step = [[NEVER] * STATES for _ in range(STATES)]
    for state in range(STATES):
        for _, cost, after in _choices(state, symbol):
            step[state][after] = min(step[state][after], cost)
    return _times(INSERTS, tuple(map(tuple, step)))


def advance(symbol: int, length: int, left: Vector) -> Vector:
    """What is left to pay before a run, from what is left after it."""
    exponent = 0
    while length:
        if length & 1:
            left = _onto(power(symbol, exponent), left)
        length >>= 1
        exponent += 1
    return left


def run_matrix(runs: list[list[int]]) -> Matrix:
    """The product over all runs."""
    total = IDENTITY
    for symbol, length in runs:
        exponent = 0
        while length:
            if length & 1:
                total = _times(total, power(symbol, exponent))
            length >>= 1
            exponent += 1
    return total


def unroll(runs: list[list[int]], state: int, left: Vector, last: bool) -> tuple[str, int]:
    """The ASCII-least letters of the cheapest edits from a state on, and the state they lead to.

    `left` is what is left to pay after the runs, by state; with `last` the inserts after the last
    row are added.
    """
    after = [left]
    for symbol, length in reversed(runs):
        after.append(advance(symbol, length, after[-1]))
    after.reverse()
    letters = []
    for at, (symbol, length) in enumerate(runs):
        if symbol >= MUST_GO:  # an insert here costs no less after the run, and D comes before I
            letters.append("D" * length)
            continue
        inside = [after[at + 1]]
        for _ in range(length):
            inside.append(_onto(power(symbol, 0), inside[-1]))
        for k in range(length, 0, -1):
            now, then = inside[k], inside[k - 1]
            while True:
                edits = {c: (cost, to) for c, cost, to in _choices(state, symbol)}
                cost, to = edits["D"]
                if cost + then[to] == now[state]:
                    letters.append("D")
                    break
                if INSERT + now[FOLLOWS[state]] == now[state]:
                    letters.append("I")
                    state = FOLLOWS[state]
                    continue
                letter = "K" if "K" in edits and edits["K"][0] + then[edits["K"][1]] == now[state] else "R"
                letters.append(letter)
                state = edits[letter][1]
                break
    while last and state not in ENDS:
        letters.append("I")
        state = FOLLOWS[state]
    return "".join(letters), state


# --- damage and faults ------------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and `copies` after the damage that crc32 of id and turn decides."""
    key = F.concat_ws(
        ":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    )
    dealt = rows.select(
        "conv_id",
        "turn",
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
        (F.crc32(key) % 20).alias("_fate"),
    )
    fate = F.col("_fate")
    text = F.when(fate == 1, F.lit("")).when(fate == 2, F.regexp_replace("text", "[.!?]", ""))
    return dealt.select(
        "conv_id",
        "turn",
        F.when(fate == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _row_key() -> Column:
    """Tells roles and texts of one conversation apart."""
    return F.md5(
        F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")
    )


def _units(rows: DataFrame) -> DataFrame:
    """Equal rows of a conversation counted: conv_id, turn, role, key, fault, n (0: a row that is
    gone, which only says that the conversation exists)."""
    there = F.col("copies") > 0
    solid = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = (
        F.when(solid == "", "b").when(F.substring(solid, -1, 1).rlike("[.!?]"), "-").otherwise("t")
    )
    return (
        rows.select(
            "conv_id",
            F.when(there, F.col("turn")).alias("turn"),
            F.when(there, F.col("role")).otherwise("").alias("role"),
            F.when(there, _row_key()).otherwise("").alias("key"),
            F.when(there, fault).otherwise("-").alias("fault"),
            "copies",
        )
        .groupBy("conv_id", "turn", "role", "key", "fault")
        .agg(F.sum("copies").alias("n"))
    )


def _place() -> Column:
    """A turn as a value that has an order, nulls first."""
    return F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))


def _repeats(units: DataFrame) -> DataFrame:
    """Units whose role and text their conversation has at an earlier turn."""
    own = F.md5(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), "key"))
    solid = units.filter("n > 0 AND fault <> 'b'").withColumn("own", own)
    many = solid.groupBy("own").agg(F.min(_place()).alias("first"), F.count("*").alias("units"))
    many = materialize(many.filter("units > 1"), "repeated")
    joined = join_groups(solid.withColumn("place", _place()), many, "own", "units")
    return joined.filter("place <> first").select("conv_id", "turn", "role", "key")


# --- segments: the rows of a conversation in one range ----------------------------------------

_SEGMENT = (
    "conv_id bigint, part int, edge boolean, symbols binary, lengths array<bigint>, "
    "matrix array<bigint>, audit string, cost bigint, blank bigint, duplicate bigint, "
    "truncated bigint, illegal bigint, n_rows bigint, first_role string, last_role string, "
    "turns bigint, first_turn bigint, last_turn bigint"
)
_FIGURES = ["blank", "duplicate", "truncated", "illegal", "cost"]


def _arrow(ddl: str) -> pa.Schema:
    kinds = {
        "bigint": pa.int64(),
        "int": pa.int32(),
        "boolean": pa.bool_(),
        "string": pa.string(),
        "binary": pa.binary(),
        "array<bigint>": pa.list_(pa.int64()),
        "array<string>": pa.list_(pa.string()),
    }
    return pa.schema([(n, kinds[kind]) for n, kind in (c.split() for c in ddl.split(", "))])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


class _Segment:
    """Runs and counts of the rows seen so far."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.runs: list[list[int]] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.rows = self.turns = 0
        self.first_role = self.last_role = self.first_turn = self.last_turn = None

    def _add(self, symbol: int, times: int) -> None:
        if self.runs and self.runs[-1][0] == symbol:
            self.runs[-1][1] += times
        elif times:
            self.runs.append([symbol, times])

    def take(self, turn: int | None, role: str, fault: str, n: int, repeated: bool) -> None:
        initial = role[:1]
        if self.rows and self.last_role + initial not in LEGAL:
            self.illegal += 1
        if turn is not None:
            if self.turns == 0:
                self.first_turn = turn
            self.turns += turn != self.last_turn
            self.last_turn = turn
        self.first_role = initial if self.first_role is None else self.first_role
        self.last_role = initial
        self.illegal += n - 1
        self.rows += n
        of = CLASSES.find(initial) if initial else OTHER
        of = OTHER if of < 0 else of
        if fault == "b":
            self.blank += n
            self._add(of + MUST_GO, n)
            return
        again = n if repeated else n - 1
        if not repeated:
            self.truncated += fault == "t"
            self._add(of + (CUT if fault == "t" else NO_FAULT), 1)
        self.duplicate += again
        self._add(of + MUST_GO, again)

    def row(self, part: int, edge: bool) -> tuple:
        matrix = audit = cost = None
        if edge:
            matrix = [c for line in run_matrix(self.runs) for c in line]
        else:
            audit, _ = unroll(self.runs, 0, END, True)
            left = END
            for symbol, length in reversed(self.runs):
                left = advance(symbol, length, left)
            cost = left[0]
        return (
            self.conv_id,
            part,
            edge,
            bytes(s for s, _ in self.runs) if edge else None,
            [n for _, n in self.runs] if edge else None,
            matrix,
            audit,
            cost,
            self.blank,
            self.duplicate,
            self.truncated,
            self.illegal,
            self.rows,
            self.first_role,
            self.last_role,
            self.turns,
            self.first_turn,
            self.last_turn,
        )


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered rows of one range to segments; the first and the last may go on in other ranges."""
    schema = _arrow(_SEGMENT)
    names = ("conv_id", "turn", "role", "fault", "n", "part")
    now, started, repeated = None, 0, False
    for batch in batches:
        done = []
        columns = [batch.column(c).to_pylist() for c in names]
        for conv_id, turn, role, fault, n, part in zip(*columns, strict=True):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    done.append(now.row(part, started == 1))
                now, started, repeated = _Segment(conv_id), started + 1, False
            if fault == "r":
                repeated = True
            elif n:
                now.take(turn, role, fault, n, repeated)
                repeated = False
        if done:
            yield _batch(done, schema)
    if now is not None:
        yield _batch([now.row(part, True)], schema)


_BORDER = "conv_id bigint, part int, left array<bigint>, last boolean, gaps bigint, " + ", ".join(
    f"{f} bigint" for f in _FIGURES
)


def _borders(rows: pa.Table) -> pa.Table:
    """What is left to pay after each segment of a conversation, and the conversation's figures.

    There is a row per range at most: counts and a matrix, no runs and no texts.
    """
    found = sorted(rows.to_pylist(), key=lambda r: r["part"])
    lefts = [END]
    for r in reversed(found):
        flat = r["matrix"]
        matrix = tuple(tuple(flat[k : k + STATES]) for k in range(0, STATES * STATES, STATES))
        lefts.append(_onto(matrix, lefts[-1]))
    lefts.reverse()
    figures = {f: sum(r[f] for r in found) for f in _FIGURES[:4]}
    filled = [r for r in found if r["n_rows"]]
    for a, b in zip(filled, filled[1:]):
        figures["illegal"] += a["last_role"] + b["first_role"] not in LEGAL
    timed = [r for r in found if r["turns"]]
    turns = sum(r["turns"] for r in timed)
    turns -= sum(a["last_turn"] == b["first_turn"] for a, b in zip(timed, timed[1:]))
    gaps = timed[-1]["last_turn"] - timed[0]["first_turn"] + 1 - turns if timed else 0
    totals = (gaps, *figures.values(), lefts[0][0])
    return pa.Table.from_batches(
        [
            _batch(
                [
                    (r["conv_id"], r["part"], list(left), r is found[-1], *totals)
                    for r, left in zip(found, lefts[1:], strict=True)
                ],
                _arrow(_BORDER),
            )
        ]
    )


_PIECE = "conv_id bigint, part int, audits array<string>, follows array<bigint>"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The letters of a segment from each state that it may be entered in."""
    for batch in batches:
        found = []
        for r in batch.to_pylist():
            runs = list(zip(r["symbols"], r["lengths"], strict=True))
            ways = [unroll(runs, s, tuple(r["left"]), r["last"]) for s in range(STATES)]
            found.append((r["conv_id"], r["part"], [a for a, _ in ways], [s for _, s in ways]))
        yield _batch(found, _arrow(_PIECE))


def _spanning(segments: DataFrame) -> DataFrame:
    """Figures and audits of the conversations at the borders of the ranges."""
    edges = segments.filter("edge")
    slim = edges.drop("edge", "symbols", "lengths", "audit", "cost")
    borders = materialize(slim.groupBy("conv_id").applyInArrow(_borders, _BORDER), "borders")
    beside = borders.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), "left", "last")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part"))
    unrolled = (
        edges.select("conv_id", "part", "symbols", "lengths")
        .join(beside, same)
        .select("conv_id", "part", "symbols", "lengths", "left", "last")
        .mapInArrow(_pieces, _PIECE)
    )
    walked = F.aggregate(
        F.sort_array(F.collect_list(F.struct("part", "audits", "follows"))),
        F.struct(F.lit(0).cast("long").alias("state"), F.lit("").alias("audit")),
        lambda walk, piece: F.struct(
            F.element_at(piece["follows"], (walk["state"] + 1).cast("int")).alias("state"),
            F.concat(
                walk["audit"], F.element_at(piece["audits"], (walk["state"] + 1).cast("int"))
            ).alias("audit"),
        ),
    )
    audits = unrolled.groupBy("conv_id").agg(walked["audit"].alias("audit"))
    totals = borders.filter("last").select(F.col("conv_id").alias("_conv"), "gaps", *_FIGURES)
    return audits.join(totals, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")


def _judged(rows: DataFrame) -> DataFrame:
    """Per conversation gaps, faults, cost and audit, from digests and flags of the damaged rows."""
    units = materialize(_units(rows), "units")
    marks = _repeats(units).select("*", F.lit("r").alias("fault"), F.lit(0).cast("long").alias("n"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "key")]
    ordered = (
        units.unionByName(marks)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order, (F.col("fault") == "r").desc())
        .select("conv_id", "turn", "role", "fault", "n", F.spark_partition_id().alias("part"))
    )
    segments = materialize(ordered.mapInArrow(_segments, _SEGMENT), "segments")
    gaps = F.when(F.col("turns") > 0, F.expr("last_turn - first_turn + 1 - turns")).otherwise(0)
    figures = ["conv_id", "audit", "gaps", *_FIGURES]
    whole = segments.filter("NOT edge").withColumn("gaps", gaps.cast("long")).select(*figures)
    return whole.unionByName(_spanning(segments).select(*figures))


# --- the repaired text -------------------------------------------------------------------------

_REPORT = "conv_id bigint, gaps bigint, " + ", ".join(
    [*(f"{f} bigint" for f in _FIGURES), "audit string", "repaired_sha256 string"]
)


class _Repair:
    """Applies the letters of an audit to the rows as they come and hashes the lines that stay."""

    def __init__(self, head: dict):
        self.head, self.audit, self.at, self.state = head, head["audit"], 0, 0
        self.hash, self.empty = hashlib.sha256(), True

    def _line(self, role: str, text: str) -> None:
        self.hash.update((("" if self.empty else "\n") + role + ":" + text).encode())
        self.empty = False

    def _insert(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._line(PUT_IN[self.state], "")
            self.state, self.at = FOLLOWS[self.state], self.at + 1

    def take(self, role: str, text: str) -> None:
        self._insert()
        letter, self.at = self.audit[self.at], self.at + 1
        if letter == "K":
            self._line(role, text)
            self.state = _kept(self.state, CLASSES.index(role[0]))
        elif letter == "R":
            self._line(PUT_IN[self.state], text)
            self.state = FOLLOWS[self.state]

    def row(self) -> tuple:
        self._insert()
        figures = [self.head[f] for f in ("conv_id", "gaps", *_FIGURES, "audit")]
        return (*figures, self.hash.hexdigest())


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation its report; the first row of each has the audit, the others are in order."""
    schema, now = _arrow(_REPORT), None
    for batch in batches:
        done = []
        heads = batch.select(["conv_id", "audit", "gaps", *_FIGURES])
        columns = [batch.column(c).to_pylist() for c in ("is_row", "role", "text", "copies")]
        for i, (is_row, role, text, copies) in enumerate(zip(*columns, strict=True)):
            if not is_row:
                if now is not None:
                    done.append(now.row())
                now = _Repair(heads.slice(i, 1).to_pylist()[0])
            for _ in range(copies):
                now.take(role, text)
        if done:
            yield _batch(done, schema)
    if now is not None:
        yield _batch([now.row()], schema)


def repaired(conversations: DataFrame) -> DataFrame:
    """Per conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit and the SHA-256 of the
    repaired conversation."""
    rows = damaged(conversations)
    judged = materialize(_judged(rows), "audits")
    texts = rows.filter("copies > 0").select(
        "conv_id", F.lit(True).alias("is_row"), "turn", "role", _row_key().alias("key"), "text", "copies"
    )
    heads = judged.select("*", F.lit(False).alias("is_row"), F.lit(0).cast("long").alias("copies"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "is_row", "turn", "role", "key")]
    stream = (
        texts.unionByName(heads, allowMissingColumns=True)
        .repartition("conv_id")
        .sortWithinPartitions(*order)
    )
    return small_batches(stream).mapInArrow(_hashed, _REPORT)
