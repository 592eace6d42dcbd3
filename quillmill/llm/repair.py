"""Repair of the turn structure of conversations by the auction algorithm for shortest paths.

The rows of a conversation and the state of its roles (nothing yet, after system, after user, after assistant) span a lattice.
Its arcs are the edits with whole-number costs: Keep, Rerole, Delete and Insert. Node prices start at nothing; a path grows from
its origin along an arc whose price difference meets its cost, and where there is none the end node's price is raised
to the least it can be and the path gives up that node. Once the path arrives, prices and costs meet along all shortest
paths, and nowhere else between reached nodes: of these tight arcs the one of the ASCII-least letter is followed.

Conversations of any length: rows are laid in order and cut into pieces of ``PIECE`` rows. A piece that is a whole conversation is solved at
once. Of longer ones the auction gives each piece's costs between its boundary states; these are summed from the end, and each piece is
solved again from every state in which it can begin, against the costs of what follows. One piece's rows are all that a task holds.
The hash and the audit of a conversation are made from a sorted stream of its rows.

Edge cases: nulls of role, text and turn count as one space in the texts and hashes; rows without a turn come first; a null ``conv_id`` is
a conversation like others. Rows of one turn stand by role, then by the hash of their text; repeated rows stand together, and
all but the first are duplicates. A role that begins with none of s, u, a cannot be kept; an empty role has the empty initial.
A conversation all whose rows are gone has zeros, an empty audit and the hash of the empty string. An empty
table gives no rows. Further columns are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quillmill.operators.running import laid_in_order
from quillmill.session import written

#: Rows of a conversation that one lattice holds: 2 to this power.
PIECE_BITS = 6

# What the edits cost
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5

#: States: nothing yet, after system, after user, after assistant. A repaired conversation ends in the first or the last.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ENDS = {NOTHING: 0, ASSISTANT: 0}

#: What a rerole or an insert makes in a state, and where it leads.
_NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` and ``copies`` after the damage that crc32 of ``conv_id:turn`` names."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20
    held = rows.select("conv_id", "turn", told("role").alias("role"), told("text").alias("text"), kind.alias("_kind")).filter("_kind != 0")
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("_kind") == 3, 2).otherwise(1)
    return held.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.cast("bigint").alias("copies"))


# -- the lattice of a piece ------------------------------------------------------------------------------


def _step(state: int, initial: str) -> int | None:
    """Where keeping a role leads, if it may stand there."""
    if initial == "s":
        return SYSTEM if state == NOTHING else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


def arcs(rows: list[tuple[str, bool, bool]], k: int, state: int) -> list[tuple[str, int, int, int]]:
    """The edits possible before row ``k`` (initial, must go, truncated) in a state: letter, cost, next row, next state; letters ascend."""
    found = []
    if k < len(rows):
        found.append(("D", DELETE, k + 1, state))
    found.append(("I", INSERT, k, _NEXT[state]))
    if k < len(rows) and not rows[k][1]:
        extra = TRUNCATED * rows[k][2]
        kept = _step(state, rows[k][0])
        if kept is not None:
            found.append(("K", extra, k + 1, kept))
        found.append(("R", REROLE + extra, k + 1, _NEXT[state]))
    return found


class Auction:
    """Shortest paths from any state before the first row to the end, at whose states ``ends`` are the costs of what follows.

    Prices are kept from one origin to the next, as they stay valid for the same end.
    """

    def __init__(self, rows: list[tuple[str, bool, bool]], ends: dict[int, int]):
        n = len(rows)
        self.end = 4 * (n + 1)
        self.arcs = [[(letter, cost, 4 * k + q) for letter, cost, k, q in arcs(rows, node // 4, node % 4)] for node in range(self.end)]
        for state, cost in ends.items():
            self.arcs[4 * n + state].append(("", cost, self.end))
        self.arcs.append([])
        self.prices = [0] * (self.end + 1)

    def run(self, origin: int) -> int:
        """The cost of the shortest path from a state before the first row."""
        prices, out, path = self.prices, self.arcs, [origin]
        while path[-1] != self.end:
            node = path[-1]
            best, to = min((cost + prices[j], j) for _, cost, j in out[node])
            if prices[node] < best:  # contraction: the price rises, and the path gives up its end
                prices[node] = best
                if node != origin:
                    path.pop()
            else:  # extension along a tight arc
                path.append(to)
        return prices[origin] - prices[self.end]

    def trace(self, origin: int) -> tuple[str, int]:
        """After ``run(origin)``: the least letters along tight arcs that lead to the end, and the state there."""
        prices, reaches = self.prices, [False] * self.end + [True]
        # within a row an insert leads to another state of the row: two sweeps over a row's states settle it
        for k in range(self.end // 4 - 1, -1, -1):
            for _ in range(4):
                for node in range(4 * k, 4 * k + 4):
                    reaches[node] = reaches[node] or any(reaches[j] and prices[node] == cost + prices[j] for _, cost, j in self.arcs[node])
        node, letters, last = origin, [], origin
        while node != self.end:
            last = node
            letter, node = min((letter or "~", j) for letter, cost, j in self.arcs[node] if reaches[j] and prices[node] == cost + prices[j])
            letters.append(letter)
        return "".join(letters[:-1]), last % 4


def between(rows: list[tuple[str, bool, bool]], origins: list[int]) -> list[list[int]]:
    """Costs from each state before a piece to each state behind it (a state that cannot be reached costs ``FAR``)."""
    table = [[FAR] * 4 for _ in range(4)]
    for end in range(4):
        # the end states that no path leads to would raise prices without end: only NOTHING and SYSTEM can be such
        auction = Auction(rows, {end: 0})
        for origin in origins:
            if _reachable(rows, origin, end):
                table[origin][end] = auction.run(origin)
    return table


#: More than any repair costs: deleting a row costs 2 and inserting a pair 10.
FAR = 1 << 50


def _reachable(rows: list[tuple[str, bool, bool]], origin: int, end: int) -> bool:
    """Deletes lead everywhere but to states that only rows can bring about: USER and ASSISTANT can always be inserted."""
    if end in (USER, ASSISTANT) or origin == end:
        return True
    return end == SYSTEM and origin == NOTHING and any(initial == "s" and not gone for initial, gone, _ in rows)


# -- over Spark -------------------------------------------------------------------------------------------

_PLACE = "conv_id, turn, role, name"


def _rows(found: DataFrame) -> DataFrame:
    """One narrow row for each different row of a turn: ``n`` copies, what is wrong with it, its number ``at`` in the order.

    ``first`` marks the first row of a role and text in its conversation; ``opens`` and ``closes`` mark the ends of the conversation.
    """
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    narrow = found.select(
        "conv_id", "turn", "role", F.md5(F.col("text").cast("binary")).alias("name"), "copies",
        (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"),
    )
    # equal rows are counted where they are read, and travel as one
    grouped = narrow.groupBy("conv_id", "turn", "role", "name").agg(
        F.sum("copies").alias("n"), F.max("blank").alias("blank"), F.max("cut").alias("cut"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "name"]
    placed = laid_in_order(grouped, order, "at", "turns")
    # marks are rows themselves and meet theirs by the number, of which each has one
    marks = placed.groupBy("conv_id", "role", "name").agg(F.min("at").alias("at")).select("at", F.lit(1).alias("mark"))
    edges = placed.groupBy("conv_id").agg(F.min("at").alias("_first"), F.max("at").alias("_last"))
    marks = marks.unionByName(edges.select(F.explode(F.array(
        F.struct(F.col("_first").alias("at"), F.lit(2).alias("mark")), F.struct(F.col("_last").alias("at"), F.lit(4).alias("mark")))).alias("m")).select("m.*"))
    marked = placed.join(marks.groupBy("at").agg(F.sum("mark").alias("marks")), "at", "left")
    has = lambda bit: F.coalesce(F.col("marks"), F.lit(0)).bitwiseAND(bit) > 0
    return marked.select(*placed.columns, has(1).alias("first"), has(2).alias("opens"), has(4).alias("closes"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of one piece at a time, from rows sorted by ``piece`` and ``at``."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (row["conv_id"], row["piece"]) != (held[0]["conv_id"], held[0]["piece"]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _lattice(rows: list[dict]) -> list[tuple[str, bool, bool]]:
    """Every copy of every row as (initial, must go, truncated)."""
    found = []
    for row in rows:
        initial, gone = row["role"][:1], row["blank"] or not row["first"]
        found.append((initial, gone, row["cut"]))
        found.extend([(initial, True, False)] * (row["n"] - 1))
    return found


def _edits(rows: list[dict], letters: str) -> list[dict]:
    """For each row the letters before and at it; the letters behind the last row go with it."""
    found, k = [], 0
    for row in rows:
        start, left = k, row["n"]
        while left:
            left -= letters[k] != "I"
            k += 1
        found.append({c: row[c] for c in ("conv_id", "turn", "role", "name", "at", "n", "blank", "first", "cut")} | {"letters": letters[start:k]})
    found[-1]["letters"] += letters[k:]
    return found


_EDITS = "{place}, at bigint, n bigint, blank boolean, first boolean, cut boolean, letters string"
_COSTS = "conv_id {t}, piece bigint, costs array<bigint>"


def _schema(ddl: str, df: DataFrame) -> str:
    types = dict(df.dtypes)
    place = ", ".join(f"{c} {types[c]}" for c in _PLACE.split(", "))
    return ddl.format(place=place, t=types["conv_id"])


def _to_arrow(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _batched(items: Iterator[list[dict]], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for rows in items:
        held.extend(rows)
        if len(held) >= size:
            yield _to_arrow(held, schema)
            held = []
    if held:
        yield _to_arrow(held, schema)


def _mapped(df: DataFrame, keys: list[str], order: list, ddl: str, each) -> DataFrame:
    """``each`` over the sorted rows of every task."""
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    # a stated number: the work is in the lattices, not in the bytes by which Spark would join small partitions
    dealt = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    return dealt.sortWithinPartitions(*order).mapInArrow(lambda batches: _batched(each(batches), schema), ddl)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    for rows in _pieces(batches):
        auction = Auction(_lattice(rows), ENDS)
        auction.run(NOTHING)
        yield _edits(rows, auction.trace(NOTHING)[0])


def _costs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    for rows in _pieces(batches):
        origins = [NOTHING] if rows[0]["opens"] else [NOTHING, SYSTEM, USER, ASSISTANT]
        table = between(_lattice(rows), origins)
        yield [{"conv_id": rows[0]["conv_id"], "piece": rows[0]["piece"], "costs": sum(table, [])}]


def _costs_to_go(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """From the last piece of a conversation to its first: what it costs to go on from each state behind a piece."""
    conv, go = (), None
    for batch in batches:
        for row in batch.to_pylist():
            if conv != (row["conv_id"],):
                conv, go = (row["conv_id"],), [ENDS.get(q, FAR) for q in range(4)]
            yield [{"conv_id": row["conv_id"], "piece": row["piece"], "costs": list(go)}]
            go = [min(FAR, *[row["costs"][4 * q + r] + go[r] for r in range(4)]) for q in range(4)]


def _from_every_state(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """A piece's edits for each state that it can begin in: what they lead to, then the rows."""
    for rows in _pieces(batches):
        least = min(rows[0]["costs"])
        # only differences count, and prices have less far to rise
        lattice, ends = _lattice(rows), {q: c - least for q, c in enumerate(rows[0]["costs"]) if c < FAR}
        auction = Auction(lattice, ends)
        for origin in [NOTHING] if rows[0]["opens"] else range(4):
            if not any(_reachable(lattice, origin, q) for q in ends):
                continue
            auction.run(origin)
            letters, end = auction.trace(origin)
            yield [edit | {"piece": rows[0]["piece"], "begins": origin, "ends": end} for edit in _edits(rows, letters)]


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """From each conversation's first piece on, the state that every piece begins in."""
    conv, state, piece, leads = (), NOTHING, None, {}
    for batch in batches:
        for row in batch.to_pylist():
            if conv != (row["conv_id"],):
                conv, state, piece, leads = (row["conv_id"],), NOTHING, row["piece"], {}
            elif piece != row["piece"]:
                state, piece, leads = leads[state], row["piece"], {}
            leads[row["begins"]] = row["ends"]
            if row["begins"] == state:
                yield [{"conv_id": row["conv_id"], "piece": row["piece"], "begins": state}]


def edits(found: DataFrame) -> DataFrame:
    """The cheapest edits of damaged rows: the narrow rows with ``letters``, the edits before and at each."""
    rows = written(_rows(found).withColumn("piece", F.shiftright("at", PIECE_BITS)), "turn-pieces")
    # a conversation in one piece has both its ends there
    ends = rows.filter("opens or closes").groupBy("conv_id", "piece").agg((F.max("opens") & F.max("closes")).alias("whole"))
    short = ends.filter("whole").select("conv_id", "piece")
    key = ["conv_id", "piece"]
    place = [F.col("conv_id").asc_nulls_first(), "piece", "at"]
    same = lambda a, b: a["conv_id"].eqNullSafe(b["conv_id"]) & (a["piece"] == b["piece"])
    edit_ddl = _schema(_EDITS, rows)
    solved = _mapped(rows.join(short, same(rows, short), "left_semi"), key, place, edit_ddl, _whole)
    long = written(rows.join(short, same(rows, short), "left_anti"), "long-conversations")
    costs = _mapped(long, key, place, _schema(_COSTS, rows), _costs)
    # a row of sixteen numbers for each 256 rows: these alone meet by conversation
    back = [F.col("conv_id").asc_nulls_first(), F.col("piece").desc()]
    to_go = _mapped(costs, ["conv_id"], back, _schema(_COSTS, rows), _costs_to_go)
    to_go = to_go.select(F.col("conv_id").alias("_conv"), F.col("piece").alias("_piece"), "costs")
    ready = long.join(to_go, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("piece") == F.col("_piece"))).drop("_conv", "_piece")
    more = ", piece bigint, begins int, ends int"
    every = written(_mapped(ready, key, place, edit_ddl + more, _from_every_state), "edits-by-state")
    leads = every.select("conv_id", "piece", "begins", "ends").distinct()
    begun = _mapped(leads, ["conv_id"], [F.col("conv_id").asc_nulls_first(), "piece", "begins"], _schema("conv_id {t}, piece bigint, begins int", rows), _followed)
    taken = every.join(begun, same(every, begun) & (every["begins"] == begun["begins"]), "left_semi").select(*solved.columns)
    return solved.unionByName(taken)


_RESULT = (
    "conv_id {t}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
)
_LEGAL = {"su", "ua", "au"}


class _Conversation:
    """What is gathered along the sorted rows of one conversation."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.least, self.most, self.turn = conv_id, 0, None, None, None
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.initial, self.state, self.letters, self.hash, self.lines, self.open = None, NOTHING, [], hashlib.sha256(), 0, None
        self.made: list[tuple[str, str]] = []

    def line(self, role: str, text: str) -> None:
        self.hash.update((b"\n" if self.lines else b"") + f"{role}:{text}".encode())
        self.lines += 1
        self.made.append((role, text))

    def insert(self) -> None:
        self.state = _NEXT[self.state]
        self.cost += INSERT
        self.line(NAMES[self.state], "")

    def edit(self, row: dict) -> None:
        """A row's edits; its text, if it stays, comes with the next row of the stream."""
        n, turn, initial = row["n"], row["turn"], row["role"][:1]
        if turn is not None:
            self.turns += turn != self.turn
            self.least, self.most, self.turn = turn if self.least is None else self.least, turn, turn
        if row["blank"]:
            self.blank += n
        else:
            self.duplicate += n - row["first"]
            self.truncated += row["first"] and row["cut"]
        self.illegal += (self.initial is not None and self.initial + initial not in _LEGAL) + (n - 1)
        self.initial = initial
        letters, self.open = row["letters"], None
        self.letters.append(letters)
        kept = max(letters.find("K"), letters.find("R"))
        for letter in letters if kept < 0 else letters[:kept]:
            self.cost += DELETE if letter == "D" else 0
            if letter == "I":
                self.insert()
        if kept >= 0:
            self.open = (letters[kept:], row["cut"])

    def text(self, row: dict) -> None:
        if self.open is None:
            return
        letters, cut = self.open
        self.open = None
        role = row["role"]
        if letters[0] == "K":
            self.state = _step(self.state, role[:1])
        else:
            self.state = _NEXT[self.state]
            self.cost += REROLE
            role = NAMES[self.state]
        self.cost += TRUNCATED * cut
        self.line(role, row["text"])
        for letter in letters[1:]:
            self.cost += DELETE if letter == "D" else 0
            if letter == "I":
                self.insert()

    def result(self) -> dict:
        gaps = 0 if self.least is None else min(self.most - self.least + 1 - self.turns, 2**63 - 1)
        return {
            "conv_id": self.conv_id, "gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
            "illegal": self.illegal, "cost": self.cost, "audit": "".join(self.letters), "repaired_sha256": self.hash.hexdigest(),
        }


_MARK, _EDIT, _TEXT = range(3)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one; a batch of long texts is turned into Python values a few rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            yield from batch.slice(start, 256).to_pylist()


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Conversation, bool]]:
    """The conversation after every row of the stream, and whether it is over."""
    held = None
    for row in _slices(batches):
        if held is None or held.conv_id != row["conv_id"]:
            if held is not None:
                yield held, True
            held = _Conversation(row["conv_id"])
        if row["kind"] == _EDIT:
            held.edit(row)
        elif row["kind"] == _TEXT:
            held.text(row)
        yield held, False
    if held is not None:
        yield held, True


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    for held, over in _read(batches):
        held.made.clear()
        if over:
            yield [held.result()]


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    for held, over in _read(batches):
        first = held.lines - len(held.made)
        if held.made:
            yield [{"conv_id": held.conv_id, "turn": first + k, "role": r, "text": t} for k, (r, t) in enumerate(held.made)]
        held.made.clear()


def _told(rows: DataFrame) -> DataFrame:
    """Marks, edits and texts of all conversations in one table, to be read in order."""
    found = damaged(rows)
    narrow = edits(found).select("conv_id", "turn", "role", "name", "n", "blank", "first", "cut", "letters")
    texts = found.select("conv_id", "turn", "role", F.md5(F.col("text").cast("binary")).alias("name"), "text").withColumn("kind", F.lit(_TEXT))
    marks = rows.select("conv_id").distinct().withColumn("kind", F.lit(_MARK))
    parts = narrow.withColumn("kind", F.lit(_EDIT)).unionByName(texts, allowMissingColumns=True)
    return parts.unionByName(marks, allowMissingColumns=True)


def _in_order(rows: DataFrame, ddl: str, each) -> DataFrame:
    told = _told(rows)
    order = [F.col("conv_id").asc_nulls_first(), F.col("kind") != _MARK, F.col("turn").asc_nulls_first(), "role", "name", "kind"]
    return _mapped(told, ["conv_id"], order, _schema(ddl, told), each)


def repair_report(rows: DataFrame) -> DataFrame:
    """One row for each ``conv_id``: what was wrong after the damage, the cost and letters of its repair, the hash of the repaired rows."""
    return _in_order(rows, _RESULT, _finished)


def repaired_rows(rows: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``turn`` numbered anew from 0, ``role`` and ``text``."""
    return _in_order(rows, "conv_id {t}, turn bigint, role string, text string", _lines)
