"""Least-cost repair of conversations by depth-first branch and bound.

A repaired conversation has the role initials ``(s?(ua)+)?``. Keeping a row costs 0, another role 2,
deleting it 3 (a must for blank and duplicate rows), an inserted empty turn 2, and a truncated row
that stays 1. The cheapest list of edits wins, the least in ASCII order among equals.

A conversation's rows are numbered without meeting in one task and cut into runs of ``RUN``. Every
run is a string of letters, one for a row's initial and fault, and is searched for each state it may
be entered and left in: an explicit stack, suffix lower bounds, an incumbent (cost, audit), and a
dominance table for each row, until nothing is left that could be better. The runs of a conversation
are then put together from their costs and the order of their audits alone: an audit of a run never
begins another of the same run and entry, since each holds one edit for each row and ends with it, so
the first run in which two lists differ decides. Texts travel once, to the digest of the repaired
conversation, which is read in order and holds one run's edits at a time.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitview.llm.common import crc32_sql, free_name, map_arrow, materialise, numbered

#: Rows searched at once.
RUN = 256
BLANKS = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1

# States: START, nothing yet (may end); LED, after s; ASKED, after u; ANSWERED, after a (may end).
START, LED, ASKED, ANSWERED = range(4)
STATES = range(4)
#: Role that an inserted or renamed turn must have in a state, and the state after it.
NEXT = {START: ("u", ASKED), LED: ("u", ASKED), ASKED: ("a", ANSWERED), ANSWERED: ("u", ASKED)}
#: Insertions that end a conversation in a state.
ENDING = {START: "", LED: "II", ASKED: "I", ANSWERED: ""}

#: A row's letter: initial s, u, a or x for any other; capital if truncated, a digit if it must go.
INITIAL = dict(zip("suaxSUAX1234", "suax" * 3, strict=True))


def row_edits(letter: str, state: int) -> list[tuple[int, str, int]]:
    """``(cost, edit, next state)`` of the edits of one row, in ASCII order."""
    edits = [(DELETE, "D", state)]
    if not letter.isdigit():
        surcharge, initial = TRUNCATED * letter.isupper(), letter.lower()
        role, after = NEXT[state]
        if initial == role:
            edits.append((KEEP + surcharge, "K", after))
        elif initial == "s" and state == START:
            edits.append((KEEP + surcharge, "K", LED))
        edits.append((REROLE + surcharge, "R", after))
    return edits


def suffix_bounds(letters: str, asked: bool) -> list[tuple[int, int]]:
    """For every row, least costs of the rows from it on where the next turn is a user's and where it
    is an assistant's, if the run is left in ASKED (or else with a user's turn next).

    No s stands for free here; while nothing stands yet, the search takes ``LEAD`` off the bound for it.
    """
    bounds = [(NEVER, 0) if asked else (0, NEVER)]
    for letter in reversed(letters):
        user, assistant = bounds[-1]
        if letter.isdigit():
            bounds.append((DELETE + user, DELETE + assistant))
            continue
        surcharge, initial = TRUNCATED * letter.isupper(), letter.lower()
        as_user = surcharge + assistant + (KEEP if initial == "u" else REROLE)
        as_assistant = surcharge + user + (KEEP if initial == "a" else REROLE)
        bounds.append((min(DELETE + user, as_user, INSERT + as_assistant), min(DELETE + assistant, as_assistant, INSERT + as_user)))
    return bounds[::-1]


#: What a leading s may save against the bound, which renames or deletes it.
LEAD = DELETE
NEVER = 1 << 40


def search(letters: str, entry: int, end: int, expanded: list | None = None) -> tuple[int, str] | None:
    """Best ``(cost, audit)`` of a run entered in one state and left in another; None if it can't be.

    Depth first: of a node's children the least (bound, audit) is taken next. A prefix is dropped
    when its bound and audit are over the incumbent's, or when another reached its row and state at
    no greater cost and with no greater audit. A turn is inserted right before a row that stays: one
    before a deleted row may as well follow it, and two in a row only cost more. ``expanded`` takes
    the rows of the nodes expanded.
    """
    n, bounds = len(letters), suffix_bounds(letters, end == ASKED)
    best: tuple[int, str] | None = None
    reached: list[dict[int, tuple[int, str]]] = [{} for _ in range(n + 1)]

    def bound(cost: int, state: int, row: int) -> int:
        lead = LEAD * (state == START)
        if end in (START, LED):  # all rows go, but for one s
            return cost + max(0, DELETE * (n - row) - lead) if state in (START, LED) else NEVER
        return cost + max(0, bounds[row][state == ASKED] - lead)

    stack = [(bound(0, entry, 0), "", 0, entry, 0)]
    while stack:
        least, audit, cost, state, row = stack.pop()
        known = reached[row].get(state)
        if least >= NEVER or (best and (least, audit) > best) or (known and known <= (cost, audit)):
            continue
        reached[row][state] = (cost, audit)
        if expanded is not None:
            expanded.append(row)
        if row == n:
            if state == end:
                best = min(best or (cost, audit), (cost, audit))
            continue
        edits = [(price, edit, after) for price, edit, after in row_edits(letters[row], state)]
        edits += [(INSERT + price, "I" + edit, after) for price, edit, after in row_edits(letters[row], NEXT[state][1]) if edit != "D"]
        children = [(bound(cost + price, after, row + 1), audit + edit, cost + price, after, row + 1) for price, edit, after in edits]
        stack.extend(sorted(children, reverse=True))
    return best


@functools.lru_cache(4096)  # conversations of a few turns repeat
def run_table(letters: str, entries: tuple[int, ...]) -> tuple[list[int], list[int], list[str]]:
    """Cost (-1: none), rank of the audit among those of its entry, and audit for each entry and exit."""
    costs, ranks, audits = [-1] * 16, [0] * 16, [""] * 16
    for entry in entries:
        found = {end: way for end in STATES if (way := search(letters, entry, end))}
        for rank, (audit, end, cost) in enumerate(sorted((a, e, c) for e, (c, a) in found.items())):
            costs[4 * entry + end], ranks[4 * entry + end], audits[4 * entry + end] = cost, rank, audit
    return costs, ranks, audits


def choose(runs: list[tuple[list[int], list[int]]]) -> tuple[int, list[int]]:
    """Least cost of a conversation, and each run's place in its table, from ``(costs, ranks)`` of all runs."""
    left = [INSERT * len(ENDING[s]) for s in STATES]
    after = [left]
    for costs, _ in reversed(runs):
        ways = [[costs[4 * e + x] + left[x] for x in STATES if costs[4 * e + x] >= 0] for e in STATES]
        left = [min(w, default=NEVER) for w in ways]
        after.append(left)
    after.reverse()
    state, places = START, []
    for (costs, ranks), here, then in zip(runs, after, after[1:], strict=False):
        ways = [x for x in STATES if costs[4 * state + x] >= 0 and costs[4 * state + x] + then[x] == here[state]]
        leave = min(ways, key=lambda x: ranks[4 * state + x])
        places.append(4 * state + leave)
        state = leave
    return after[0][START], places


def _key(conv: str) -> Column:
    """Text of a conversation's id that is never null."""
    return F.coalesce(F.concat(F.lit("+"), F.col(conv).cast("string")), F.lit("-"))


def damaged(rows: DataFrame) -> DataFrame:
    """The rows as the registered query damages them, by the crc32 of ``conv_id:turn`` modulo 20."""
    words = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.pmod(F.crc32(F.concat_ws(":", *words).cast("binary")), F.lit(20))
    text = F.coalesce(F.col("text"), F.lit(" "))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(kind == 4, "user").otherwise(F.coalesce(F.col("role"), F.lit(" ")))
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    found = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("times"))
    return found.select("conv_id", "turn", "role", "text", F.explode(F.expr("array_repeat(0, times)")).alias("copy")).drop("copy")


def repair(rows: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` of every
    conversation of ``rows`` (conv_id, turn, role, text; further columns are ignored).

    Rows stand by turn, nulls first, rows of one turn by role and then by a hash of the text; a null
    role or text is one space. Rows of a null ``conv_id`` are one conversation. A role that begins with
    neither s, u nor a can't stay as it is. An empty table gives no row.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    conv = free_name(rows, "c")
    plain = rows.select(_key("conv_id").alias(conv), F.col("conv_id"), F.col("turn"), role.alias("role"), text.alias("text"))
    plain = plain.withColumnRenamed(conv, "c")
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.xxhash64("text"), F.md5("text")]
    placed = numbered(plain, ["c"], order, "turns").select("c", "conv_id", "turn", "role", "text", "pos")
    light = materialise(_faults(placed), "faults")
    runs = materialise(_runs(light), "runs")
    chosen = materialise(_chosen(runs), "audits")
    counts = light.groupBy("c").agg(
        F.first("conv_id").alias("conv_id"),
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        *(F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")),
    )
    digests = _digests(placed, chosen.select("c", "run", "audit"))
    whole = chosen.groupBy("c").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("run", "audit"))), lambda x: x["audit"]), "").alias("audit"),
        F.max("cost").alias("cost"), F.max("illegal").alias("illegal"),
    )
    found = counts.join(whole, "c").join(digests, "c")
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _faults(placed: DataFrame) -> DataFrame:
    """One light row per turn: its first fault and its letter."""
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    light = placed.select(
        "c", "conv_id", "turn", "pos", F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
        (body == "").alias("blank"), (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("open"),
        F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))).alias("same"),
    )
    # only texts that repeat are joined; a hot one is a skewed join key, which adaptive execution splits
    firsts = light.where("not blank").groupBy("c", "same").agg(F.min("pos").alias("first"), F.count("*").alias("times")).where("times > 1")
    light = light.join(firsts.drop("times"), ["c", "same"], "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("pos") > F.col("first"), "duplicate").when(F.col("open"), "truncated")
    light = light.select("c", "conv_id", "turn", "pos", "initial", fault.alias("fault"))
    letter = F.when(F.col("fault").isin("blank", "duplicate"), F.translate("initial", "suax", "1234")).when(F.col("fault") == "truncated", F.upper("initial"))
    return light.withColumn("letter", F.coalesce(letter, F.col("initial")))


def _runs(light: DataFrame) -> DataFrame:
    """Runs of rows with their search tables: ``(c, run, letters, illegal, costs, ranks, audits)``."""
    letters = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "letter"))), lambda x: x["letter"]), "")
    # letters are few bytes and long work: as many tasks as the session's shuffles have, however small
    tasks = int(light.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = light.select("c", F.expr(f"pos div {RUN}").alias("run"), "pos", "letter").repartition(tasks, "c", "run")
    runs = rows.groupBy("c", "run").agg(letters.alias("letters"))

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = list(zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True))
            tables = [run_table(x, tuple(STATES) if run else (START,)) for run, x in rows]
            illegal = [sum(INITIAL[a] + INITIAL[b] not in ("su", "ua", "au") for a, b in zip(x, x[1:], strict=False)) for _, x in rows]
            columns = [*part.columns, pa.array(illegal, pa.int64())]
            columns += [pa.array([t[0] for t in tables], pa.list_(pa.int64())), pa.array([t[1] for t in tables], pa.list_(pa.int64())), pa.array([t[2] for t in tables], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "illegal", "costs", "ranks", "audits"])

    return map_arrow(runs, task, "c string, run long, letters string, illegal long, costs array<long>, ranks array<long>, audits array<string>")


def _chosen(runs: DataFrame) -> DataFrame:
    """``(c, run, audit, cost, illegal)``: every run's share of the best audit; cost and illegal are the
    conversation's. The last run's share ends with the closing insertions."""
    ends = F.struct("run", "costs", "ranks", "illegal", F.left("letters", F.lit(1)).alias("first"), F.right("letters", F.lit(1)).alias("last"))
    whole = runs.groupBy("c").agg(F.array_sort(F.collect_list(ends)).alias("runs"))

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for c, found in zip(*(x.to_pylist() for x in part.columns), strict=True):
                cost, places = choose([(r["costs"], r["ranks"]) for r in found])
                illegal = sum(r["illegal"] for r in found)
                illegal += sum(INITIAL[a["last"]] + INITIAL[b["first"]] not in ("su", "ua", "au") for a, b in zip(found, found[1:], strict=False))
                n = len(found)
                tails = [""] * (n - 1) + [ENDING[places[-1] % 4]]
                columns = [pa.array([c] * n, pa.string()), pa.array([r["run"] for r in found], pa.int64()), pa.array(places, pa.int32()), pa.array(tails, pa.string()), pa.array([cost] * n, pa.int64()), pa.array([illegal] * n, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["c", "run", "place", "tail", "cost", "illegal"])

    places = map_arrow(whole, task, "c string, run long, place int, tail string, cost long, illegal long")
    audit = F.concat(F.element_at("audits", F.col("place") + 1), F.col("tail"))
    return runs.select("c", "run", "audits").join(places, ["c", "run"]).select("c", "run", audit.alias("audit"), "cost", "illegal")


class Repaired:
    """Digest of one repaired conversation, fed in order: a run's audit, then its rows."""

    def __init__(self):
        self.digest, self.state, self.audit, self.any = hashlib.sha256(), START, iter(""), False

    def _line(self, role: str, text: str) -> None:
        if self.any:
            self.digest.update(b"\n")
        self.any = True
        self.digest.update(f"{role}:{text}".encode())

    def _turn(self, text: str, role: str | None = None) -> None:
        """A turn of the role that is next, or of ``role``."""
        if role is None:
            initial, self.state = NEXT[self.state]
            role = "user" if initial == "u" else "assistant"
        elif role[0] == "s":
            self.state = LED
        else:
            self.state = NEXT[self.state][1]
        self._line(role, text)

    def run(self, audit: str) -> None:
        self.audit = iter(audit)

    def row(self, role: str, text: str) -> None:
        for edit in self.audit:
            if edit == "I":
                self._turn("")
                continue
            if edit != "D":
                self._turn(text, role if edit == "K" else None)
            return

    def end(self) -> str:
        for _ in self.audit:
            self._turn("")
        return self.digest.hexdigest()


def _digests(placed: DataFrame, audits: DataFrame) -> DataFrame:
    """``(c, repaired_sha256)``. A conversation's digest is one chain, so its rows are read in one task,
    in order and without being held."""
    rows = placed.select("c", "pos", F.lit(1).alias("kind"), "role", "text")
    plans = audits.select("c", (F.col("run") * RUN).alias("pos"), F.lit(0).alias("kind"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"))

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, whole = None, Repaired()
        schema = pa.schema([("c", pa.string()), ("repaired_sha256", pa.string())])
        for part in parts:
            done = []
            for c, _, kind, role, text in zip(*(x.to_pylist() for x in part.columns), strict=True):
                if c != now:
                    if now is not None:
                        done.append((now, whole.end()))
                    now, whole = c, Repaired()
                if kind:
                    whole.row(role, text)
                else:
                    whole.run(text)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*done, strict=True)], schema=schema)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([whole.end()])], schema=schema)

    stream = plans.unionByName(rows).repartition("c").sortWithinPartitions("c", "pos", "kind")
    return map_arrow(stream, task, "c string, repaired_sha256 string")


def damaged_and_repaired(rows: DataFrame) -> DataFrame:
    """Repair of the damaged rows, one row for every ``conv_id`` of the undamaged ones. A conversation
    of which no row is left has zeros, an empty audit and the digest of the empty text."""
    found = repair(damaged(rows)).withColumnRenamed("conv_id", "__conv")
    ids = rows.select("conv_id").distinct()
    joined = ids.join(found, F.col("conv_id").eqNullSafe(F.col("__conv")), "left")
    longs = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return joined.select("conv_id", *longs, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))


def oracle_sql() -> str:
    """The damaged and repaired ``conversations`` in DuckDB: the same edits by tables of least costs,
    row by row, and the repaired texts by replaying the audits."""
    blanks = " || ".join(f"chr({ord(c)})" for c in BLANKS)
    return f"""
    WITH RECURSIVE kinds AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
        FROM conversations),
    rows_ AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
               unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
        FROM kinds),
    ids AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
    placed AS (
        SELECT c, turn, role, text, rtrim(text, {blanks}) AS body, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS pos
        FROM rows_ r JOIN ids ON r.conv_id IS NOT DISTINCT FROM ids.conv_id),
    faults AS (
        SELECT *, left(role, 1) AS initial, CASE WHEN body = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
        FROM (SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY pos) AS nth FROM placed)),
    pairs AS (SELECT c, count(*) FILTER (initial || follows NOT IN ('su', 'ua', 'au')) AS illegal
              FROM (SELECT c, initial, lead(initial) OVER (PARTITION BY c ORDER BY pos) AS follows FROM faults) WHERE follows IS NOT NULL GROUP BY c),
    counts AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                      count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, max(pos) AS n
               FROM faults GROUP BY c),
    inserted(state, edits, price, next) AS (VALUES (0, '', 0, 0), (0, 'I', 2, 2), (0, 'II', 4, 3), (1, '', 0, 1), (1, 'I', 2, 2), (1, 'II', 4, 3),
                                                   (2, '', 0, 2), (2, 'I', 2, 3), (3, '', 0, 3), (3, 'I', 2, 2)),
    edits(state, edit, initial, price, next) AS (VALUES (0, 'K', 's', 0, 1), (0, 'K', 'u', 0, 2), (1, 'K', 'u', 0, 2), (2, 'K', 'a', 0, 3), (3, 'K', 'u', 0, 2),
                                                        (0, 'R', NULL, 2, 2), (1, 'R', NULL, 2, 2), (2, 'R', NULL, 2, 3), (3, 'R', NULL, 2, 2)),
    costs AS (
        SELECT c, 0::BIGINT AS pos, 0 AS state, {{'cost': 0, 'audit': ''}} AS way FROM counts
        UNION ALL
        SELECT c, pos, next, min(way) FROM (
            SELECT f.c, f.pos, e.next, {{'cost': w.way.cost + i.price + e.price + CASE WHEN f.fault = 'truncated' THEN 1 ELSE 0 END, 'audit': w.way.audit || i.edits || e.edit}} AS way
            FROM costs w JOIN faults f ON f.c = w.c AND f.pos = w.pos + 1 JOIN inserted i ON i.state = w.state
            JOIN edits e ON e.state = i.next AND (e.initial IS NULL OR e.initial = f.initial)
            WHERE f.fault IS NULL OR f.fault = 'truncated'
            UNION ALL
            SELECT f.c, f.pos, w.state, {{'cost': w.way.cost + 3, 'audit': w.way.audit || 'D'}} FROM costs w JOIN faults f ON f.c = w.c AND f.pos = w.pos + 1)
        GROUP BY c, pos, next),
    best AS (
        SELECT c, min({{'cost': way.cost + CASE state WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 0 END, 'audit': way.audit || CASE state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END}}) AS way
        FROM costs JOIN counts USING (c) WHERE pos = n GROUP BY c),
    replay AS (
        SELECT c, way.audit AS audit, 0 AS k, 0::BIGINT AS pos, 0 AS state, []::VARCHAR[] AS lines FROM best
        UNION ALL
        SELECT r.c, audit, k + 1, r.pos + CASE WHEN edit = 'I' THEN 0 ELSE 1 END,
               CASE WHEN edit = 'D' THEN state WHEN edit = 'K' AND f.initial = 's' THEN 1 WHEN state = 2 THEN 3 ELSE 2 END,
               CASE WHEN edit = 'D' THEN lines ELSE list_append(lines, CASE WHEN edit = 'K' THEN f.role WHEN state = 2 THEN 'assistant' ELSE 'user' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE f.text END) END
        FROM (SELECT *, substr(audit, k + 1, 1) AS edit FROM replay WHERE k < length(audit)) r LEFT JOIN faults f ON f.c = r.c AND f.pos = r.pos + 1)
    SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
           coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(way.cost, 0)::BIGINT AS cost,
           coalesce(way.audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
    FROM ids LEFT JOIN counts USING (c) LEFT JOIN pairs USING (c) LEFT JOIN best USING (c)
    LEFT JOIN replay ON replay.c = ids.c AND replay.k = length(replay.audit)
    """
