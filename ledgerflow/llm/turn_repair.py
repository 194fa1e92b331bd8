"""Conversation structure repair by Wagner-Fischer alignment with an alternating grammar.

The role initials of a repaired conversation are ``(s?(ua)+)?``. Edits of its rows, in order: keep (K, 0), rerole to user
or assistant (R, 3), delete (D, 4, required for blank and duplicate rows), insert an empty text of either role (I, 3); a
truncated row that stays costs 3 more. The cheapest edits win, of equal ones the audit (their letters) that is least.

Alignment: what follows a leading ``s`` is a tail of ...uaua, so one table of costs, by rows left and letters left, serves
every feasible length of the grammar string; the cost of a length is a cell of its first line. Ukkonen bands bound the
cells of each line: the incumbent is a cheap feasible repair, and a cell counts only if the inserts or deletes that it
needs leave it at or below the incumbent's cost. The audits of all cheapest lengths are traced back and compared. The
trace keeps costs of every k-th line and computes the moves between them again, so memory grows with the root of the
length of a conversation, times its band.

Distribution: rows are shuffled once by conversation and sorted; each conversation passes twice, first as marks without
texts, from which the edits are found, then as texts, which are hashed as they come. So a task holds some marks for each
row of one conversation and no texts. Python reads the sorted rows in Arrow batches.

Cases: a null role, text or (in the hash that damages) turn is one space, a null id is a conversation of its own; rows of
equal turn are taken by role, then by the hash of their text; repeated rows are duplicates; a conversation without rows
has zeros, an empty audit and the hash of the empty string; an empty table has no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.text import pick

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows up to which repairs of equal marks are remembered.
SHORT = 16
_BLANKS = " \t\n\u000b\u000c\r"
_D, _I, _K, _R = 1, 2, 4, 8
_LETTERS = ((_D, "D"), (_I, "I"), (_K, "K"), (_R, "R"))
_FAR = np.int32(1 << 29)

Marks = list[tuple[str, bool, bool]]


class _Alignment:
    """Costs of aligning the rows i.. of a conversation with the last r letters of ...uaua, and the audits they give.

    A row is (role initial, must go, truncated).
    """

    def __init__(self, rows: Marks) -> None:
        self.rows = rows
        n = len(rows)
        gone = np.array([g for _, g, _ in rows], bool)
        cut = np.array([t for _, _, t in rows], bool) & ~gone
        stay = ~gone
        # rows that can stay, and the costs that no repair avoids, from each row on
        self.left = np.append(np.cumsum(stay[::-1])[::-1], 0)
        self.base = np.append(np.cumsum((DELETE * gone + TRUNCATED * cut)[::-1])[::-1], 0)
        self.bound = self._incumbent()
        spare = self.bound - int(self.base[0])
        # deleting a truncated row costs little more than keeping it
        cheap = int(cut.sum()) * (DELETE - TRUNCATED)
        self.fewer = spare if spare <= cheap else int(cut.sum()) + (spare - cheap) // DELETE
        self.more = spare // INSERT
        self.step = max(1, int(np.sqrt(n)))
        self.kept: dict[int, tuple[int, np.ndarray]] = {}
        self.leads: list[tuple[int, np.ndarray]] = []
        self._fill()

    def _incumbent(self) -> int:
        """The cost of one feasible repair: every row that can stay stays, letters are inserted where they are missing."""
        total, want = 0, "u"
        for at, (role, gone, cut) in enumerate(self.rows):
            if gone:
                total += DELETE
                continue
            total += TRUNCATED if cut else 0
            if role not in ("u", "a"):
                total += REROLE
            elif role != want:
                total += INSERT
                want = "a" if want == "u" else "u"
            want = "a" if want == "u" else "u"
        total += INSERT if want == "a" else 0
        return min(total, DELETE * len(self.rows))

    def _band(self, i: int) -> tuple[int, int]:
        left = int(self.left[i])
        return max(0, left - self.fewer), left + self.more

    def _line(self, i: int, below: tuple[int, np.ndarray] | None) -> tuple[tuple[int, np.ndarray], np.ndarray]:
        """(first r, costs) of line i, from the line under it, and the cheapest moves of each cell as bits."""
        low, high = self._band(i)
        r = np.arange(low, high + 1)
        gone_to = np.full(len(r), _FAR, np.int32)
        matched = np.full(len(r), _FAR, np.int32)
        same = np.zeros(len(r), bool)
        if below is None:
            costs = np.where(r == 0, 0, _FAR).astype(np.int32)
        else:
            role, gone, cut = self.rows[i]
            first, under = below
            gone_to = DELETE + _reach(under, r - first)
            if not gone:
                same = np.where(r % 2 == 0, "u", "a") == role
                cost = np.where(same, 0, REROLE).astype(np.int32) + (TRUNCATED if cut else 0)
                matched = np.where(r > 0, _reach(under, r - 1 - first) + cost, _FAR)
            costs = np.minimum(gone_to, matched)
        slope = (INSERT * r).astype(np.int32)
        costs = np.minimum(np.minimum.accumulate(costs - slope) + slope, _FAR)
        moves = np.where((costs == gone_to) & (costs < _FAR), _D, 0)
        moves |= np.where((costs == matched) & (costs < _FAR), np.where(same, _K, _R), 0)
        inserted = np.full(len(r), _FAR, np.int32)
        inserted[1:] = costs[:-1] + INSERT
        moves |= np.where((costs == inserted) & (costs < _FAR), _I, 0)
        return (low, costs), moves.astype(np.uint8)

    def _fill(self) -> None:
        n = len(self.rows)
        line, _ = self._line(n, None)
        self.kept[n] = line
        # (i, tail): the leading s is row i, everything before it deleted
        before = np.concatenate([[0], np.cumsum(np.full(n, DELETE))])
        self.best, self.ends = self.bound, []
        for i in range(n - 1, -1, -1):
            role, gone, cut = self.rows[i]
            if role == "s" and not gone:
                self._offer(line, int(before[i]) + (TRUNCATED if cut else 0), i, 2)
            line, _ = self._line(i, line)
            if i % self.step == 0:
                self.kept[i] = line
        self._offer(line, 0, -1, 0)

    def _offer(self, line: tuple[int, np.ndarray], extra: int, lead: int, least: int) -> None:
        """Take the tails of the cheapest lengths: rows up to ``lead`` are deleted but for it, which is kept."""
        low, costs = line
        tails = np.arange(low, low + len(costs))
        usable = (tails % 2 == 0) & (tails >= least)
        totals = np.where(usable, costs + extra, _FAR)
        cheapest = int(totals.min()) if len(totals) else int(_FAR)
        if cheapest < self.best:
            self.best, self.ends = cheapest, []
        if cheapest == self.best:
            self.ends += [(lead, int(t)) for t in tails[totals == cheapest]]

    def audit(self) -> tuple[int, str, bool]:
        """The least cost, the least of the cheapest audits, and whether a system row leads it."""
        found = min((("D" * lead + "K" if lead >= 0 else "") + self._trace(lead + 1, tail), lead >= 0) for lead, tail in self.ends)
        return self.best, found[0], found[1]

    def _trace(self, i: int, r: int) -> str:
        out, block, moves = [], None, {}
        n = len(self.rows)
        while i < n or r > 0:
            if block is None or i not in moves:
                top = i // self.step * self.step
                under = min(k for k in self.kept if k > i) if i < n else n
                line = self.kept[under]
                moves = {n: self._line(n, None)[1]} if under == n else {}
                for k in range(min(under, n) - 1, top - 1, -1):
                    line, moves[k] = self._line(k, line)
                block = top
            low, _ = self._band(i)
            bits = int(moves[i][r - low])
            bit, letter = next(x for x in _LETTERS if bits & x[0])
            out.append(letter)
            i += bit != _I
            r -= bit != _D
        return "".join(out)


def _reach(line: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The costs at these places of a line, out of reach outside it."""
    inside = (at >= 0) & (at < len(line))
    return np.where(inside, line[np.clip(at, 0, len(line) - 1)], _FAR).astype(np.int32)


def repair(rows: Marks) -> tuple[int, str, str]:
    """(cost, audit, role initials) of the cheapest repair of rows (role initial, must go, truncated)."""
    if not rows:
        return 0, "", ""
    cost, audit, led = _Alignment(rows).audit()
    length = len(audit) - audit.count("D")
    return cost, audit, "s" * led + "ua" * ((length - led) // 2)


@lru_cache(1 << 15)
def _repair_short(rows: tuple[tuple[str, bool, bool], ...]) -> tuple[int, str, str]:
    """``repair`` for conversations of a few rows, whose marks often repeat."""
    return repair(list(rows))


def damaged(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, turn, role, text, damage): the rows with the damage that the hash of id and turn names."""
    rows = pick(conversations, conv_id, turn, role, text).toDF("conv_id", "turn", "role", "text")
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    damage = (F.crc32(key.cast("binary")) % 20).cast("int")
    rows = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), damage.alias("damage"))
    mended = (
        F.when(F.col("damage") == 1, F.lit(""))
        .when(F.col("damage") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
    )
    return rows.withColumn("text", mended).withColumn("role", F.when(F.col("damage") == 4, F.lit("user")).otherwise(F.col("role")))


def _passes(rows: DataFrame) -> DataFrame:
    """Every row as marks (pass 0) and, unless it is dropped, as text (pass 1)."""
    gone = F.col("damage") == 0
    words = F.translate("text", _BLANKS, "")
    marked = rows.select(
        "conv_id",
        "turn",
        "role",
        F.unhex(F.md5(F.col("text").cast("binary"))).alias("key"),
        F.when(gone, F.lit(0)).when(F.col("damage") == 3, F.lit(2)).otherwise(F.lit(1)).alias("times"),
        (words == "").alias("blank"),
        (~F.substring(words, -1, 1).isin(".", "!", "?")).alias("cut"),
        "text",
    )
    both = F.when(F.col("times") == 0, F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    return marked.withColumn("pass", F.explode(both)).withColumn("text", F.when(F.col("pass") == 1, F.col("text")))


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_TEXTS = ["audit", "repaired_sha256"]


class _Conversation:
    """One conversation while its rows pass by."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.turns: set[int] = set()
        self.seen: set[tuple[str, bytes]] = set()
        self.rows: Marks = []
        self.faults = [0, 0, 0]
        self.illegal = 0
        self.plan: Iterator[tuple[str, str]] | None = None
        self.digest = hashlib.sha256()
        self.lines = 0

    def mark(self, turn: int | None, role: str, key: bytes, times: int, blank: bool, cut: bool) -> None:
        for _ in range(times):
            if turn is not None:
                self.turns.add(turn)
            again = (role, key) in self.seen
            self.seen.add((role, key))
            kind = 0 if blank else 1 if again else 2 if cut else None
            if kind is not None:
                self.faults[kind] += 1
            if self.rows:
                self.illegal += (self.rows[-1][0] + role[:1]) not in ("su", "ua", "au")
            self.rows.append((role[:1], kind in (0, 1), kind == 2))

    def decide(self) -> None:
        self.seen.clear()
        few = len(self.rows) <= SHORT
        self.cost, self.audit, letters = _repair_short(tuple(self.rows)) if few else repair(self.rows)
        names = iter(letters)
        self.plan = iter([(x, next(names) if x != "D" else "") for x in self.audit])

    def _write(self, role: str, text: str) -> None:
        self.digest.update(("\n" if self.lines else "").encode() + role.encode() + b":" + text.encode())
        self.lines += 1

    def read(self, role: str | None, text: str, times: int) -> None:
        """The next row (or, without a role, the end): inserts before it, then what becomes of it."""
        names = {"u": "user", "a": "assistant"}
        left = times
        while left:
            edit, letter = next(self.plan, ("", ""))
            if edit == "I":
                self._write(names[letter], "")
                continue
            if edit in ("K", "R"):
                self._write(role if edit == "K" else names[letter], text)
            left -= 1

    def result(self) -> tuple:
        if self.plan is None:
            self.decide()
        self.read(None, "", 1)  # inserts behind the last row
        gaps = max(self.turns) - min(self.turns) + 1 - len(self.turns) if self.turns else 0
        return (self.conv_id, gaps, *self.faults, self.illegal, self.cost, self.audit, self.digest.hexdigest())


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "turn", "role", "key", "times", "blank", "cut", "pass"]
    current, out = None, []

    def done(kind: pa.DataType) -> pa.RecordBatch:
        kinds = [kind, *[pa.int64()] * len(_COUNTS), *[pa.string()] * len(_TEXTS)]
        arrays = [pa.array(list(column), k) for column, k in zip(zip(*out), kinds)]
        out.clear()
        return pa.RecordBatch.from_arrays(arrays, ["conv_id", *_COUNTS, *_TEXTS])

    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(name)).to_pylist() for name in names]
        texts = batch.column(batch.schema.get_field_index("text"))
        kind = batch.schema.field("conv_id").type
        for at, (conv, turn, role, key, times, blank, cut, number) in enumerate(zip(*columns)):
            if current is None or conv != current.conv_id:
                if current is not None:
                    out.append(current.result())
                current = _Conversation(conv)
            if number == 0:
                current.mark(turn, role, key, times, blank, cut)
            else:
                if current.plan is None:
                    current.decide()
                current.read(role, texts[at].as_py(), times)
        if out:
            yield done(kind)
    if current is not None:
        out.append(current.result())
        yield done(kind)


def repair_conversations(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Faults, cheapest repair and the hash of the repaired text of every damaged conversation."""
    rows = _passes(damaged(conversations, conv_id, turn, role, text))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("key")]
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "pass", *order)
    schema = T.StructType(
        [T.StructField("conv_id", rows.schema["conv_id"].dataType)]
        + [T.StructField(name, T.LongType()) for name in _COUNTS]
        + [T.StructField(name, T.StringType()) for name in _TEXTS]
    )
    return dealt.mapInArrow(_run, schema).withColumnRenamed("conv_id", conv_id)
