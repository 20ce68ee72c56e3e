"""Conversation structure repair by Wagner-Fischer alignment to the alternating grammar.

The role initials of a sound conversation are ``(s?(ua)+)?``: an optional system turn, then user and assistant in turn, or nothing. There is one target
string of each feasible length, so an audit (the initials of the edits Delete, Insert, Keep, Rerole in order) says all about a repair. Turns are aligned to the strings ``suaua...``
and ``uaua...``; the lengths of one string are columns of one table of costs. The cells filled lie in Ukkonen's band: a greedy repair gives the incumbent cost, and what
it costs to come off the diagonal may not exceed it. Of the cheapest lengths, cells on a cheapest path are traced back, and the audits are compared: ASCII-least wins.

A long conversation is aligned in blocks of turns. What a block leaves open is only the place in the grammar (nothing yet, after s, u or a), so per place the
cheapest, ASCII-least audit is kept with the running hash of its repair; audits of equal cost at one place cannot begin with one another, so the least beginning gives
the least whole. Rows come sorted, and a task holds one block of texts at a time: a conversation of any length is one pass of bounded memory besides its audit, and its hash is sequential by nature.

Faults of a turn, the first counts: blank (nothing but white space), duplicate (role and text seen earlier in the conversation), truncated (the last character that is not white space is none of ``.!?``).
Null roles and texts are one space; turns come by number, nulls first, then role and text; a null conversation id is a conversation of its own; turns alike in all are one after
the other and all but the first are duplicates; an empty table gives an empty result; empty and very long texts are fine; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loamgrid.llm.common import WS

#: Turns aligned at once.
BLOCK = 256
#: What an edit costs; a truncated turn that is not deleted costs one more.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
NAMES = {"u": "user", "a": "assistant"}
#: Places in the grammar: nothing yet, after s, after u, after a; where a conversation may end; the strings that may follow: first letter or two, then the letters in turn.
START, ENDS = "", ("", "a")
FOLLOWS = {"": [("s", "ua"), ("", "ua")], "s": [("", "ua")], "u": [("", "au")], "a": [("", "ua")]}


def target(first: str, cycle: str, j: int) -> str:
    """Letter ``j`` of the string."""
    return first if j < len(first) else cycle[(j - len(first)) % 2]


def incumbent(codes: str, first: str, cycle: str) -> int | None:
    """A cost at which every place after the first letters can be reached: turns that fit are kept, others reroled; a last turn more can be inserted. None if no turn fits the first letter."""
    cost = j = 0
    for c in codes:
        want = target(first, cycle, j)
        if c == "d" or want == "s" != c.lower():
            cost += DELETE
        else:
            cost += (c.lower() != want) * REROLE + c.isupper() * TRUNCATED
            j += 1
    return cost + 2 * INSERT if j or not first else None


def band(codes: str, first: str, cycle: str, most: int) -> list[dict[int, int]]:
    """Per number of turns read the costs by letters written, as far as they can lead to ``most`` or less."""
    row, rows = {0: 0}, []
    for i in range(len(codes) + 1):
        low, high = i - most // DELETE, i + most // INSERT
        if i:
            c, above = codes[i - 1], row
            row = {}
            for j in range(max(0, low), high + 1):
                best = above.get(j, most) + DELETE
                if j and c != "d" and j - 1 in above:
                    want = target(first, cycle, j - 1)
                    if c.lower() == want or want != "s":
                        best = min(best, above[j - 1] + (c.lower() != want) * REROLE + c.isupper() * TRUNCATED)
                if j and j - 1 in row and target(first, cycle, j - 1) != "s":
                    best = min(best, row[j - 1] + INSERT)
                if best <= most:
                    row[j] = best
        else:
            row = {j: INSERT * j for j in range(high + 1) if not j or not first}
        rows.append(row)
    return rows


def steps(codes: str, first: str, cycle: str, rows: list[dict[int, int]], i: int, j: int) -> Iterator[tuple[str, int, int]]:
    """Edits of no waste out of a cell, ASCII-least first, with the cell they lead to."""
    cost, want = rows[i][j], target(first, cycle, j)
    c = codes[i] if i < len(codes) else ""
    if c and rows[i + 1].get(j) == cost + DELETE:
        yield "D", i + 1, j
    if want != "s" and rows[i].get(j + 1) == cost + INSERT:
        yield "I", i, j + 1
    if c and c != "d":
        more = c.isupper() * TRUNCATED
        if c.lower() == want and rows[i + 1].get(j + 1) == cost + more:
            yield "K", i + 1, j + 1
        if want != "s" and rows[i + 1].get(j + 1) == cost + REROLE + more:
            yield "R", i + 1, j + 1


def audit_of(codes: str, first: str, cycle: str, rows: list[dict[int, int]], ends: list[int]) -> str:
    """The ASCII-least audit of the cheapest paths to the cells ``ends`` of the last row."""
    good, open_ = set(), [(len(codes), j) for j in ends]
    while open_:  # back along paths of no waste
        i, j = open_.pop()
        if (i, j) in good:
            continue
        good.add((i, j))
        for a, b in ((i - 1, j), (i, j - 1), (i - 1, j - 1)):
            if a >= 0 and b in rows[a] and any((x, y) == (i, j) for _, x, y in steps(codes, first, cycle, rows, a, b)):
                open_.append((a, b))
    i = j = 0
    out, last = [], {(len(codes), j) for j in ends}
    while (i, j) not in last:  # all ends cost the same, so no path leads from one to another
        letter, i, j = next(s for s in steps(codes, first, cycle, rows, i, j) if s[1:] in good)
        out.append(letter)
    return "".join(out)


@lru_cache(maxsize=50_000)
def align(codes: str, place: str) -> dict[str, tuple[int, str]]:
    """From a place in the grammar, over turns: per place that they can lead to, the least cost and the ASCII-least audit of that cost.

    ``codes``: a letter per turn, its role's initial (``x`` for any other), upper case if truncated; ``d`` if it must be deleted.
    """
    found = {place: [(DELETE * len(codes), "D" * len(codes))]}
    for first, cycle in FOLLOWS[place]:
        most = incumbent(codes, first, cycle)
        if most is None:
            continue
        if first:  # its one letter alone: a turn kept, all others deleted
            found["s"] = [(DELETE * (len(codes) - 1) + c.isupper() * TRUNCATED, "D" * i + "K" + "D" * (len(codes) - 1 - i)) for i, c in enumerate(codes) if c in "sS"]
        rows = band(codes, first, cycle, most)
        for end in (0, 1):  # the letters of the cycle
            lengths = [j for j in rows[-1] if j > len(first) and (j - len(first) - 1) % 2 == end]
            least = min((rows[-1][j] for j in lengths), default=None)
            if least is not None:
                found.setdefault(cycle[end], []).append((least, audit_of(codes, first, cycle, rows, [j for j in lengths if rows[-1][j] == least])))
    return {p: min(x) for p, x in found.items()}


def repaired(audit: str, rows: list[tuple[str, str]], place: str) -> Iterator[tuple[str, str | None, str]]:
    """Letter of the edit, role and text (None: the turn goes) as the audit has them; the letters follow from the place in the grammar."""
    at = iter(rows)
    for k, letter in enumerate(audit):
        want = {"": "u", "s": "u", "u": "a", "a": "u"}[place]
        role, text = ("", "") if letter == "I" else next(at)
        if letter == "D":
            yield letter, None, text
            continue
        place = role[:1] if letter == "K" else want
        yield letter, role if letter == "K" else NAMES[want], text


class Repair:
    """A conversation as it is read: its counts, and per place in the grammar the cheapest audit with the hash of its repair."""

    def __init__(self):
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.last, self.turns, self.turn, self.first_turn = 0, None, 0, None, None
        self.held: list[tuple[str, str]] = []
        self.codes: list[str] = []
        self.ways = {START: (0, "", hashlib.sha256(), False)}

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        if fault:
            self.faults[fault] += 1
        initial = role[:1]
        self.illegal += self.last is not None and self.last + initial not in ("su", "ua", "au")
        self.last = initial
        if turn is not None and turn != self.turn:
            self.first_turn = turn if self.turns == 0 else self.first_turn
            self.turn, self.turns = turn, self.turns + 1
        code = initial if initial in ("s", "u", "a") else "x"
        self.codes.append("d" if fault in ("blank", "duplicate") else code.upper() if fault else code)
        self.held.append((role, text))
        if len(self.held) == BLOCK:
            self.close()

    def close(self) -> None:
        """Align the turns held and let their texts go."""
        codes, best = "".join(self.codes), {}
        for place, (cost, audit, digest, begun) in self.ways.items():
            for after, (more, edits) in align(codes, place).items():
                way = (cost + more, audit + edits, edits, place, digest, begun)
                if after not in best or way[:2] < best[after][:2]:
                    best[after] = way
        self.ways = {}
        for after, (cost, audit, edits, place, digest, begun) in best.items():
            digest = digest.copy()
            for _, role, text in repaired(edits, self.held, place):
                if role is not None:
                    digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                    begun = True
            self.ways[after] = (cost, audit, digest, begun)
        self.held, self.codes = [], []

    def result(self) -> list:
        if self.held:
            self.close()
        cost, audit, digest, _ = min((self.ways[p] for p in ENDS if p in self.ways), key=lambda w: w[:2])
        gaps = self.turn - self.first_turn + 1 - self.turns if self.turns else 0
        return [gaps, *self.faults.values(), self.illegal, cost, audit, digest.hexdigest()]


RESULT = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]


def faulty(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", alive: str | None = None) -> DataFrame:
    """``conv, turn, role, text, alive, fault`` of every turn, in the conversations' order within partitions. Turns of one role and text are told first from later by a window that holds no more than a row."""
    here = F.col(alive) if alive else F.lit(True)
    slim = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))], here.alias("alive"))
    again = F.row_number().over(Window.partitionBy("conv", "alive", "role", "text").orderBy(F.col("turn").asc_nulls_first())) > 1
    fault = F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank").when(again, "duplicate").when(~F.col("text").rlike(rf"[.!?]{WS}*\z"), "truncated")
    order = [F.col("conv"), F.col("alive"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.coalesce(F.col("fault") == "duplicate", F.lit(False))]
    return slim.withColumn("fault", fault).repartition("conv").sortWithinPartitions(*order)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def repair_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", alive: str | None = None) -> DataFrame:
    """One row per conversation: its id, ``gaps`` in the turns' numbers, ``blank``, ``duplicate``, ``truncated``, ``illegal`` neighbours, and the repair: ``cost``, ``audit``, ``repaired_sha256`` over ``role:text`` lines.

    ``alive``: a boolean column; a conversation all of whose turns are not alive has no rows left and an empty repair.
    """
    rows = faulty(turns, conv, turn, role, text, alive)
    kind = rows.schema["conv"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_type, done, now, own = None, [], None, None

        def out() -> pa.RecordBatch:
            ids, results = zip(*done, strict=True)
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(ids, key_type), *[pa.array(v, t) for v, (_, t) in zip(zip(*results, strict=True), RESULT, strict=True)]], [conv, *[n for n, _ in RESULT]])

        for batch in batches:
            key_type = batch.column(0).type
            for key, number, who, said, here, fault in rows_of([batch]):
                if own is None or key != now:
                    if own is not None:
                        done.append((now, own.result()))
                    now, own = key, Repair()
                if here:
                    own.add(number, who, said, fault)
            if len(done) >= 1000:
                yield out()
        if own is not None:
            done.append((now, own.result()))
        if done:
            yield out()

    kinds = {pa.int64(): "bigint", pa.string(): "string"}
    return rows.mapInArrow(run, ", ".join([f"`{conv}` {kind.simpleString()}", *[f"`{n}` {kinds[t]}" for n, t in RESULT]]))


def repaired_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired conversations, one row per edit: id, ``place`` from 0, ``edit``, ``turn`` (null: inserted), ``role`` and ``text`` (role null: the turn was deleted)."""
    audits = repair_conversations(turns, conv, turn, role, text).select(F.col(conv).alias("_conv"), "audit")
    rows = faulty(turns, conv, turn, role, text)
    number = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text", F.coalesce(F.col("fault") == "duplicate", F.lit(False)))
    own = rows.withColumn("_i", F.row_number().over(number))
    edits = audits.select("_conv", F.posexplode(F.split(F.col("audit"), "")).alias("place", "edit")).filter("edit <> ''")
    taken = F.sum((F.col("edit") != "I").cast("long")).over(Window.partitionBy("_conv").orderBy("place"))
    written = F.sum((F.col("edit") != "D").cast("long")).over(Window.partitionBy("_conv").orderBy("place"))
    edits = edits.withColumn("_taken", F.when(F.col("edit") != "I", taken)).withColumn("_written", written)
    joined = edits.join(own, F.col("_conv").eqNullSafe(F.col("conv")) & (F.col("_taken") == F.col("_i")), "left")
    system = F.max(((F.col("edit") == "K") & (F.col("_written") == 1) & (F.substring("role", 1, 1) == "s")).cast("long")).over(Window.partitionBy("_conv"))
    want = F.when((F.col("_written") - F.coalesce(system, F.lit(0))) % 2 == 1, "user").otherwise("assistant")
    new = F.when(F.col("edit") == "K", F.col("role")).when(F.col("edit") != "D", want)
    return joined.select(F.col("_conv").alias(conv), "place", "edit", "turn", new.alias("role"), F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text"))


def damage(turns: DataFrame) -> DataFrame:
    """Faults planted by CRC-32 of ``conv_id:turn`` modulo 20: 0 not alive, 1 no text, 2 no ``.!?``, 3 twice, 4 role user. Nulls are one space."""
    show = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.concat_ws(":", show("conv_id"), show("turn")).cast("binary")) % 20
    own = turns.select("conv_id", "turn", show("role").alias("role"), show("text").alias("text"), k.alias("k"))
    text = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    own = own.withColumns({"text": text, "role": F.when(F.col("k") == 4, "user").otherwise(F.col("role"))})
    times = F.when(F.col("k") == 3, F.lit(2)).otherwise(F.lit(1))
    return own.withColumn("copy", F.explode(F.sequence(F.lit(1), times))).select("conv_id", "turn", "role", "text", (F.col("k") != 0).alias("alive"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damage(spark.read.parquet(f"{sf_dir}/conversations.parquet")), alive="alive")


#: The same by a recursion over turns that keeps the least (cost, audit) per place in the grammar; CRC-32 bit by bit.
OP11_SQL = r"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
crc AS (
  SELECT *, xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(k) + 1), lambda i: ascii(k[i])::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda y, z: xor(y >> 1, (y & 1) * 3988292384)))) % 20 AS r FROM src),
dam AS (
  SELECT conv_id, turn, CASE WHEN r = 4 THEN 'user' ELSE role END AS role, CASE r WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM crc, range(CASE WHEN r = 3 THEN 2 ELSE 1 END) WHERE r <> 0),
flt AS (
  SELECT *, left(role, 1) AS ini, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' END AS fault FROM dam),
num AS (
  SELECT *, row_number() OVER w AS i, lag(ini) OVER w || ini AS two FROM flt WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, coalesce(fault = 'duplicate', false))),
sums AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal FROM num GROUP BY conv_id),
dp AS (
  SELECT conv_id, 0::BIGINT AS i, p, {'cost': c, 'audit': a, 'rep': r} AS w
  FROM sums, (VALUES ('', 0, '', []::VARCHAR[]), ('u', 2, 'I', ['user:']), ('a', 4, 'II', ['user:', 'assistant:'])) t(p, c, a, r)
  UNION ALL
  SELECT conv_id, i, p, min(w) FROM (
    WITH opt AS (
      SELECT num.conv_id, num.i, e.p, {'cost': w.cost + e.cost, 'audit': w.audit || e.letter, 'rep': list_concat(w.rep, e.line)} AS w
      FROM dp JOIN num ON num.conv_id IS NOT DISTINCT FROM dp.conv_id AND num.i = dp.i + 1, LATERAL (
        SELECT dp.p AS p, 3 AS cost, 'D' AS letter, []::VARCHAR[] AS line
        UNION ALL SELECT ini, CASE WHEN fault IS NULL THEN 0 ELSE 1 END, 'K', [role || ':' || text]
          WHERE coalesce(fault, '') NOT IN ('blank', 'duplicate') AND (dp.p = '' AND ini IN ('s', 'u') OR dp.p IN ('s', 'a') AND ini = 'u' OR dp.p = 'u' AND ini = 'a')
        UNION ALL SELECT CASE dp.p WHEN 'u' THEN 'a' ELSE 'u' END, CASE WHEN fault IS NULL THEN 2 ELSE 3 END, 'R', [CASE dp.p WHEN 'u' THEN 'assistant:' ELSE 'user:' END || text]
          WHERE coalesce(fault, '') NOT IN ('blank', 'duplicate')) e)
    SELECT conv_id, i, CASE WHEN x = 0 THEN p WHEN (x = 1) = (p = 'u') THEN 'a' ELSE 'u' END AS p,
      {'cost': w.cost + 2 * x, 'audit': w.audit || repeat('I', x::BIGINT),
       'rep': list_concat(w.rep, CASE x WHEN 0 THEN []::VARCHAR[] WHEN 1 THEN [CASE p WHEN 'u' THEN 'assistant:' ELSE 'user:' END]
         ELSE [CASE p WHEN 'u' THEN 'assistant:' ELSE 'user:' END, CASE p WHEN 'u' THEN 'user:' ELSE 'assistant:' END] END)} AS w
    FROM opt, (VALUES (0), (1), (2)) t(x))
  GROUP BY conv_id, i, p),
best AS (
  SELECT s.conv_id, min(w) AS w FROM sums s JOIN dp ON dp.conv_id IS NOT DISTINCT FROM s.conv_id AND dp.i = s.n WHERE p IN ('', 'a') GROUP BY s.conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
  coalesce(w.cost, 0)::BIGINT AS cost, coalesce(w.audit, '') AS audit, sha256(coalesce(array_to_string(w.rep, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
"""
