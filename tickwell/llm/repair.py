"""Conversation structure repair by target alignment (operator 11).

A conversation's role initials have to read ``(s?(ua)+)?``. Its rows are aligned to every feasible length of that string
with the edits Keep (0), Rerole to user or assistant (3), Delete (4, a must for blank and duplicate rows) and Insert of an
empty user or assistant row (3); an undeleted truncated row adds 3. The audit is the initials of the cheapest edits, of
equals the first in ASCII order; its length and the target follow from it.

Method: Wagner-Fischer. The targets of all lengths have the same endings, so one table from the end, rows of the
conversation against letters still to come, serves every length; a leading ``s`` can only be kept, so such a target is a
row kept as ``s``, all rows before it deleted, and an even length after it. Costs count from what every alignment pays (4
for a row that must go, 3 for a truncated one). Ukkonen band: a cell is evaluated only if the rows and letters left differ
by no more than the cost of the incumbent, a left-to-right repair, can buy. The audits of all lengths with the lowest cost
are traced back side by side and compared letter by letter.

Spark's part: narrow rows (an id, a turn, a role, a digest, a class) are dealt by conversation and sorted, and each
conversation becomes one audit; then the texts are dealt and sorted once, each conversation led by its audit, and the
repaired rows come out in order. Rows stream past, so a task holds of the conversation at hand about 120 bytes a row, the
band (a byte a cell) and no texts.

Defined cases: a null role or text is one space; rows are ordered by turn (null first), then role, then the SHA-256 of role
and text; repeated rows are rows of their own, so all but the first are duplicates; rows with a null conv_id form one
conversation; gaps beyond a long are the largest long; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import Scratch, bounded_batches

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
LETTERS = "DIKR"  # in ASCII order
ROLES = {"s": "system", "u": "user", "a": "assistant"}
_FAR = 1 << 40
_MEMO_ROWS = 32


def _clean(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    return turns.select(F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
                        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"))


def damaged(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) with faults by crc32(``conv_id:turn``) % 20: 0 drops the row, 1 empties its text, 2 takes
    out its ``.!?``, 3 repeats it, 4 makes it the user's."""
    rows = _clean(turns, conv_id, turn, role, text)
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.withColumn("_h", F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20).where("_h <> 0")
    rows = rows.withColumns({
        "text": F.when(F.col("_h") == 1, "").when(F.col("_h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
        "role": F.when(F.col("_h") == 4, "user").otherwise(F.col("role")),
        "_copy": F.explode(F.when(F.col("_h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))})
    return rows.drop("_h", "_copy")


# --- one conversation ------------------------------------------------------------------------------------------------

def _greedy(initials: str, faults: str) -> int:
    """The cost, beyond what all pay, of a repair from left to right: the incumbent."""
    cost, state = 0, ""
    for c, f in zip(initials, faults, strict=True):
        if f in "bd":
            continue
        fits = (c == "s" and state == "") or (c == "u" and state != "u") or (c == "a" and state == "u")
        if not fits and f == "t":  # to delete it costs 1 more than its 3
            cost += DELETE - TRUNCATED
        elif not fits:
            cost += REROLE if c not in ("u", "a") else INSERT
            state = c if c in ("u", "a") else "a" if state == "u" else "u"
        else:
            state = c
    return cost + {"u": INSERT, "s": 2 * INSERT}.get(state, 0)


def align(initials: str, faults: str) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of rows with these role initials (s, u, a, other) and faults (b, d, t, none)."""
    n = len(initials)
    must = [f in "bd" for f in faults]
    base = sum(DELETE if f in "bd" else TRUNCATED if f == "t" else 0 for f in faults)
    drop = [0 if m else DELETE - TRUNCATED if f == "t" else DELETE for m, f in zip(must, faults, strict=True)]
    incumbent = min(_greedy(initials, faults), sum(drop))

    # the table from the end: rest[i] rows that may stay, cheap[i] of them truncated; letters still to come from lo[i] on
    rest, cheap = [0] * (n + 1), [0] * (n + 1)
    for i in reversed(range(n)):
        rest[i], cheap[i] = rest[i + 1] + (not must[i]), cheap[i + 1] + (faults[i] == "t")
    lo = [max(0, r - (incumbent if incumbent <= t else t + (incumbent - t) // DELETE)) for r, t in zip(rest, cheap, strict=True)]
    hi = [r + incumbent // INSERT for r in rest]
    cost: list = [None] * (n + 1)
    letter: list = [None] * (n + 1)
    cost[n] = np.arange(lo[n], hi[n] + 1, dtype=np.int64) * INSERT
    letter[n] = np.ones(len(cost[n]), np.uint8)
    for i in reversed(range(n)):
        left = np.arange(lo[i], hi[i] + 1, dtype=np.int64)
        below = np.full(len(left) + 1, _FAR)  # the row after's costs at lo[i] - 1 .. hi[i]
        a, b = max(lo[i] - 1, lo[i + 1]), min(hi[i], hi[i + 1]) + 1
        if a < b:
            below[a - lo[i] + 1:b - lo[i] + 1] = cost[i + 1][a - lo[i + 1]:b - lo[i + 1]]
        gone = below[1:] + drop[i]
        fits = left % 2 == {"u": 0, "a": 1}.get(initials[i], 2)
        stays = below[:-1] + np.where(fits, 0, REROLE) if not must[i] else np.full(len(left), _FAR)
        best = np.minimum.accumulate(np.minimum(gone, stays) - INSERT * left) + INSERT * left
        code = np.where(fits, 2, 3).astype(np.uint8)
        code[1:][best[1:] == best[:-1] + INSERT] = 1
        code[best == gone] = 0
        cost[i], letter[i] = best, code
        if i + 1 < n and initials[i] != "s":
            cost[i + 1] = None  # only the costs behind a possible first row are read again

    # every feasible length: even ones from the first row on, odd ones behind a row kept as s
    ends: list[tuple[int, tuple[int, int, int]]] = []
    first = np.flatnonzero(np.arange(lo[0], hi[0] + 1) % 2 == 0)
    ends += [(int(cost[0][k]), (0, lo[0] + int(k), -1)) for k in first]
    before = 0
    for i in range(n):
        if before > incumbent:
            break
        if initials[i] == "s" and not must[i]:
            k = np.arange(lo[i + 1], hi[i + 1] + 1)
            k = k[(k % 2 == 0) & (k >= 2)]
            ends += [(before + int(cost[i + 1][m - lo[i + 1]]), (0, int(m), i)) for m in k]
        before += drop[i]
    best = min(c for c, _ in ends)

    # trace back all of the lowest cost at once: (row, letters to come, the row that stays as s or -1)
    cells, audit = {cell for c, cell in ends if c == best}, bytearray()
    while True:
        at = {}
        for i, m, s in cells:
            if s >= 0:
                code = 0 if i < s else 2
            elif i == n and m == 0:
                return base + best, audit.decode()  # alone: an audit can't begin another of the same cost
            else:
                code = int(letter[i][m - lo[i]])
            at.setdefault(code, []).append((i, m, s))
        code = min(at)
        audit.append(ord(LETTERS[code]))
        cells = {(i, m - 1, s) if code == 1 else (i + 1, m, -1 if i == s else s) if code == 0 or s >= 0 else (i + 1, m - 1, s) for i, m, s in at[code]}


_short = functools.lru_cache(maxsize=50_000)(align)


def target(audit: str) -> Iterator[str | None]:
    """For each edit of an audit the initial of the row it leaves, or None where it deletes."""
    size = len(audit) - audit.count("D")
    odd, at = size % 2, 0
    for edit in audit:
        if edit == "D":
            yield None
            continue
        yield "s" if odd and at == 0 else "ua"[(at - odd) % 2]
        at += 1


# --- audits ----------------------------------------------------------------------------------------------------------

AUDIT = "conv_id bigint, n_rows bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_COUNTS = AUDIT.replace(" bigint", "").replace(" string", "").split(", ")


class _Conversation:
    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.initials, self.faults, self.seen = conv_id, [], [], set()
        self.first = self.last = None
        self.distinct = 0

    def add(self, turn: int | None, initial: str, fault: str, digest: bytes) -> None:
        if fault != "b":
            fault = "d" if digest in self.seen else fault
            self.seen.add(digest)
        self.initials.append(initial)
        self.faults.append(fault)
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.distinct = turn, self.distinct + 1

    def audit(self) -> tuple:
        initials, faults = "".join(self.initials), "".join(self.faults)
        cost, audit = (_short if len(initials) <= _MEMO_ROWS else align)(initials, faults)
        gaps = 0 if self.first is None else min(self.last - self.first + 1 - self.distinct, (1 << 63) - 1)
        illegal = sum(initials[i:i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))
        return self.conv_id, len(initials), gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


_AUDIT_ARROW = pa.schema([(c, pa.string() if c == "audit" else pa.int64()) for c in _COUNTS])


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, out, size = None, [], 0
    for batch in batches:
        for conv_id, turn, initial, fault, digest in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault", "digest")), strict=True):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    out.append(now.audit())
                    size += len(out[-1][-1])
                now = _Conversation(conv_id)
            now.add(turn, initial, fault, digest)
        if len(out) >= 1000 or size >= 1 << 20:
            yield _batch(out, _AUDIT_ARROW)
            out, size = [], 0
    if now is not None:
        yield _batch([*out, now.audit()], _AUDIT_ARROW)


def _digest() -> Column:
    """Of role and text together; the role's length keeps them apart."""
    return F.unhex(F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256))


ORDER = ("conv_id", "turn", "role", "digest")


def audit_conversations(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A row for each conversation that has rows: counts of its faults, the cost and the audit of its repair."""
    bounded_batches(rows.sparkSession)
    said = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    fault = F.when(said == "", "b").when(~F.substring(said, -1, 1).isin(".", "!", "?"), "t").otherwise("-")
    initial = F.substring("role", 1, 1)
    narrow = _clean(rows, conv_id, turn, role, text).select(
        "conv_id", "turn", "role", F.when(initial.isin(*ROLES), initial).otherwise("-").alias("initial"), fault.alias("fault"), _digest().alias("digest"))
    return narrow.repartition("conv_id").sortWithinPartitions(*ORDER).mapInArrow(_audits, AUDIT)


# --- repaired rows ---------------------------------------------------------------------------------------------------

REPAIRED = "conv_id bigint, place bigint, edit string, turn bigint, role string, text string"
_REPAIRED_ARROW = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    edits, place, now = iter(()), 0, None

    def inserted(upto: bool) -> Iterator[tuple]:
        """Inserts up to the next edit of a row, whose edit and target come last."""
        nonlocal place
        for edit, initial in edits:
            if edit != "I":
                yield edit, initial
                return
            out.append((now, place, "I", None, ROLES[initial], ""))
            place += 1

    out: list[tuple] = []
    for batch in batches:
        for conv_id, audit, turn, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "turn", "role", "text")), strict=True):
            if audit is not None:  # the conversation's first row here; what is left of the one before are inserts
                list(inserted(False))
                edits, place, now = zip(audit, target(audit), strict=True), 0, conv_id
                continue
            ((edit, initial),) = inserted(True)
            if edit != "D":
                out.append((conv_id, place, edit, turn, ROLES[initial] if edit == "R" else role, text))
                place += 1
        if out:
            yield _batch(out, _REPAIRED_ARROW)
            out.clear()
    list(inserted(False))
    if out:
        yield _batch(out, _REPAIRED_ARROW)


def repair_conversations(rows: DataFrame, audits: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired rows (conv_id, place, edit, turn, role, text); turn is null for inserted ones. ``audits`` is that of the
    same rows. A conversation's rows are in one partition, by place, one conversation after another."""
    bounded_batches(rows.sparkSession)
    lead = audits.select("conv_id", "audit", *[F.lit(None).cast(t).alias(c) for c, t in (("turn", "bigint"), ("role", "string"), ("text", "string"), ("digest", "binary"))])
    said = _clean(rows, conv_id, turn, role, text).select("conv_id", F.lit(None).cast("string").alias("audit"), "turn", "role", "text", _digest().alias("digest"))
    dealt = lead.unionByName(said).repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), "turn", "role", "digest")
    return dealt.mapInArrow(_repaired, REPAIRED)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("sha256", pa.string())])
    now, digest, out = None, None, []
    for batch in batches:
        for conv_id, place, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text")), strict=True):
            if place == 0:
                if digest is not None:
                    out.append((now, digest.hexdigest()))
                now, digest = conv_id, hashlib.sha256()
            digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
        if out:
            yield _batch(out, schema)
            out = []
    if digest is not None:
        yield _batch([(now, digest.hexdigest())], schema)


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, sha256) of the ``role:text`` of each conversation's repaired rows, a line feed between; ``repaired`` must be
    as ``repair_conversations`` gives it. Rows are hashed as they pass."""
    return repaired.mapInArrow(_hashed, "conv_id bigint, sha256 string")


def repair_report(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The audit columns and ``repaired_sha256`` for every conv_id of ``ids`` (distinct), with or without rows."""
    store = Scratch(rows.sparkSession, "repair")
    audits = store.save(audit_conversations(rows), "audits")
    hashed = digests(repair_conversations(rows, audits)).withColumnRenamed("conv_id", "_hashed")
    both = audits.withColumnRenamed("conv_id", "_audited")
    out = ids.join(both, F.col("conv_id").eqNullSafe(F.col("_audited")), "left").join(hashed, F.col("conv_id").eqNullSafe(F.col("_hashed")), "left")
    counts = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in _COUNTS[1:-1]]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
