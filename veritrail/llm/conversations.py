"""Repair of conversations by cheapest edits, as shortest paths with Dial's bucket queue.

Rows are sorted by range over all conversations and cut into pieces of a bounded number of rows, so
a conversation of any length lies in many pieces that tasks work on alone. A piece is a graph of
(row, state) nodes whose arcs are the edits; costs are small integers, so a bucket queue records each
node's distance to the end. Pieces of one conversation meet in their 4 x 4 distances between states.
A walk along tight arcs, the ASCII-least first, then reads off the edits.

States are what the kept turns end with: nothing, a system turn, a user turn or an assistant turn.
"""

from __future__ import annotations

import functools
import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Rows of a piece, as a power of two.
PIECE_BITS = 11
DELETE, REROLE, INSERT, KEEP, TRUNCATED = 4, 3, 3, 0, 3
#: The state that each state's next turn leads to by role, and the turn that may be written there.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {NOTHING: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
WRITTEN = {NOTHING: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
STATES = len(NEXT)
#: Costs from each state to the end when no row is left: a turn or two are inserted.
AT_END = (0, 2 * INSERT, INSERT, 0)
FAR = 1 << 40
#: Codes up to this length are answered from memory when they come again.
SHORT = 32
WHITE = " \t\n\x0b\x0c\r"
#: A row's code: its role's initial, upper case if the text is cut off, or one of these.
BLANK, COPY = "b", "d"


# ---- a piece ---------------------------------------------------------------


def _steps(code: str, state: int):
    """(initial, cost, state after) of the ways to use up a row, in the order of initials."""
    yield "D", DELETE, state
    if code not in (BLANK, COPY):
        more = TRUNCATED if code.isupper() else 0
        to = NEXT[state].get(code.lower())
        if to is not None:
            yield "K", KEEP + more, to
        yield "R", REROLE + more, WRITTEN[state][1]


def distances(codes: str, end: tuple[int, ...]) -> list[list[int]]:
    """By row and state: the least cost from before that row to the end, whose states cost ``end``.

    Dial's algorithm from the end backwards: nodes wait in buckets by distance. Answers for short
    codes are kept, as they come again and again.
    """
    return _kept_distances(codes, end) if len(codes) <= SHORT else _distances(codes, end)


def _distances(codes: str, end: tuple[int, ...]) -> list[list[int]]:
    n = len(codes)
    back = {}  # by code and state after: (cost, state before)
    for code in set(codes):
        for state in range(STATES):
            for _, cost, to in _steps(code, state):
                back.setdefault((code, to), []).append((cost, state))
    inserted = [[p for p in range(STATES) if WRITTEN[p][1] == q] for q in range(STATES)]
    far = [[FAR] * STATES for _ in range(n + 1)]
    buckets: list[list[tuple[int, int]]] = []

    def put(i, q, cost):
        if cost < far[i][q]:
            far[i][q] = cost
            while len(buckets) <= cost - least:
                buckets.append([])
            buckets[cost - least].append((i, q))

    least = min(end)
    for q, cost in enumerate(end):
        if cost < FAR:
            put(n, q, cost)
    at = 0
    while at < len(buckets):
        waiting, cost = buckets[at], at + least
        while waiting:  # arcs of no cost add to the bucket at hand
            i, q = waiting.pop()
            if far[i][q] == cost:
                if i < n:
                    for p in inserted[q]:
                        put(i, p, cost + INSERT)
                if i:
                    for more, p in back.get((codes[i - 1], q), ()):
                        put(i - 1, p, cost + more)
        at += 1
    return far


@functools.lru_cache(maxsize=1 << 14)
def _kept_distances(codes: str, end: tuple[int, ...]) -> list[list[int]]:
    return _distances(codes, end)


def walked(codes: str, end: tuple[int, ...], state: int, last: bool) -> tuple[list[tuple[int, str, str]], int]:
    """The ASCII-least cheapest edits of a piece entered in ``state``, and the state it is left in.

    An edit is (row that it stands before or uses up, initial, role written). ``last``: no piece
    follows, and what is inserted behind the last row belongs to the place after it.
    """
    far, n, i, found = distances(codes, end), len(codes), 0, []
    while i < n:
        left = far[i][state]
        steps = [(name, to, 1) for name, cost, to in _steps(codes[i], state) if far[i + 1][to] + cost == left]
        if far[i][WRITTEN[state][1]] + INSERT == left:
            steps.append(("I", WRITTEN[state][1], 0))
        name, to, used = min(steps)
        found.append((i, name, WRITTEN[state][0] if name in "IR" else ""))
        i, state = i + used, to
    while last and state not in (NOTHING, ASSISTANT):
        found.append((n, "I", WRITTEN[state][0]))
        state = WRITTEN[state][1]
    return found, state


def _between(codes: str) -> list[int]:
    """Costs of a piece from each state before it to each state behind it, row by row."""
    ends = [distances(codes, tuple(0 if q == k else FAR for q in range(STATES)))[0] for k in range(STATES)]
    return [ends[k][q] for q in range(STATES) for k in range(STATES)]


# ---- tables ----------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with the test's damage, by crc32 of conv_id:turn modulo 20.

    0 drops a row, 1 empties its text, 2 takes its ``.!?`` away, 3 repeats it, 4 makes it a user's;
    nulls in the key, a role or a text count as one space.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"), case.alias("case"))
    body = F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    kept = rows.where("case <> 0").select("conv_id", "turn", F.when(F.col("case") == 4, "user").otherwise(F.col("role")).alias("role"), body.alias("text"), "case")
    times = F.when(F.col("case") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return kept.withColumn("time", F.explode(times)).select("conv_id", "turn", "role", "text")


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows with ``pos``, ascending by conversation, turn (null first), role and text, as a written table.

    Range partitions divide a long conversation. ``code`` does not know of copies yet.
    """
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role")]
    trimmed = F.rtrim(F.col("text"), F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    own = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    code = F.when(trimmed == "", BLANK).when(F.substring(trimmed, -1, 1).isin(".", "!", "?"), own).otherwise(F.upper(own))
    dealt = rows.repartitionByRange(*order, F.substring("text", 1, 64))
    dealt = dealt.sortWithinPartitions(*order, F.col("text").asc_nulls_first())
    named = dealt.select("*", F.monotonically_increasing_id().alias("pos"), initial.alias("initial"), code.alias("code"), F.sha2("text", 256).alias("sha"))
    return written(named, "turns")


def _coded(turns: DataFrame) -> DataFrame:
    """conv_id, pos, turn, initial, code: a row that repeats an earlier role and text has the code of copies."""
    told = turns.where(F.col("code") != BLANK)
    first = told.groupBy("conv_id", "role", "sha").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("is_first"))
    rows = turns.select("conv_id", "pos", "turn", "initial", "code").join(first, "pos", "left")
    copy = (F.col("code") != BLANK) & F.col("is_first").isNull()
    return rows.select("conv_id", "pos", "turn", "initial", F.when(copy, COPY).otherwise(F.col("code")).alias("code"))


def _pieces(coded: DataFrame) -> DataFrame:
    """conv_id, piece, first (pos), codes, initials (array): one row for at most 2**PIECE_BITS turns."""
    row = F.struct("pos", "code", "initial")
    held = coded.groupBy("conv_id", F.shiftright("pos", PIECE_BITS).alias("piece")).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    codes = F.array_join(F.transform("rows", lambda r: r["code"]), "")
    return held.select("conv_id", "piece", F.col("rows")[0]["pos"].alias("first"), codes.alias("codes"), F.col("rows.initial").alias("initials"))


def _arrow(df: DataFrame, work, schema: str, columns: list[str]) -> DataFrame:
    """``work`` (values of ``columns`` to rows of ``schema``) on each row, beside its conv_id and piece."""
    kind = df.schema["conv_id"].dataType.simpleString()
    names = [x.split()[0] for x in schema.split(", ")]
    arrow = [{"long": "int64", "string": "string"}.get(x.split()[1]) for x in schema.split(", ")]

    def run(batches):
        import pyarrow as pa

        kinds = [pa.list_(pa.int64()) if k is None else getattr(pa, k)() for k in arrow]
        for batch in batches:
            at, out = [], [[] for _ in names]
            for j, values in enumerate(zip(*(batch.column(c).to_pylist() for c in columns), strict=True)):
                for row in work(*values):
                    at.append(j)
                    for held, v in zip(out, row, strict=True):
                        held.append(v)
            yield pa.RecordBatch.from_arrays([batch.column("conv_id").take(pa.array(at, pa.int64())), *map(pa.array, out, kinds)], names=["conv_id", *names])

    return df.mapInArrow(run, f"conv_id {kind}, {schema}")


def _ends(pieces: DataFrame) -> DataFrame:
    """(conv_id, piece, end): what each state behind a piece costs, for conversations of several pieces."""

    def back(order, costs):
        """From the last piece to the first; a piece's list is its sixteen costs."""
        end = list(AT_END)
        for piece, between in reversed(list(zip(order, costs, strict=True))):
            yield piece, end
            end = [min(between[q * STATES + k] + end[k] for k in range(STATES)) for q in range(STATES)]

    crossed = _arrow(pieces, lambda piece, codes: [(piece, _between(codes))], "piece long, costs array<long>", ["piece", "codes"])
    every = crossed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("piece", "costs"))).alias("held"))
    every = every.select("conv_id", F.col("held.piece").alias("order"), F.col("held.costs").alias("costs"))
    return _arrow(every, back, "piece long, end array<long>", ["order", "costs"])


def _entered(ways: DataFrame) -> DataFrame:
    """(conv_id, piece, entry): the state in which each piece is entered, from its ways through."""

    def forth(order, exits):
        state = NOTHING
        for piece, leaves in zip(order, exits, strict=True):
            yield piece, state
            state = leaves[state]

    every = ways.groupBy("conv_id", "piece").agg(F.array_sort(F.collect_list(F.struct("entry", "leaves"))).alias("held"))
    every = every.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("piece", F.col("held.leaves").alias("leaves")))).alias("held"))
    every = every.select("conv_id", F.col("held.piece").alias("order"), F.col("held.leaves").alias("exits"))
    return _arrow(every, forth, "piece long, entry long", ["order", "exits"])


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join by keys that may be null."""
    told = right.select(*[F.col(c).alias(f"{c}_of") if c in keys else F.col(c) for c in right.columns])
    same = functools.reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{c}_of")) for c in keys])
    return left.join(told, same, how).drop(*[f"{c}_of" for c in keys])


def _edits(pieces: DataFrame) -> DataFrame:
    """conv_id, piece, entry, cost, audit, rows, roles, leaves: the walk through every piece.

    ``cost`` is the distance from before the piece; ``rows`` are the rows' places in the piece that
    the audit's letters belong to, ``roles`` what is written there.
    """

    def walk(last, states, codes, piece, end, entry):
        end = tuple(end)
        for state in states if entry is None else [entry]:
            found, leaves = walked(codes, end, state, last)
            audit = "".join(x[1] for x in found)
            yield piece, state, distances(codes, end)[0][state], audit, [x[0] for x in found], ",".join(x[2] for x in found), leaves

    schema = "piece long, entry long, cost long, audit string, rows array<long>, roles string, leaves long"
    columns = ["codes", "piece", "end", "entry"]
    sizes = pieces.groupBy("conv_id").agg(F.count("*").alias("n"), F.max("piece").alias("final"))
    several = written(sizes.where("n > 1"), "long")
    one = F.lit(None).cast("long").alias("entry")
    alone = _joined(pieces, several, ["conv_id"], "left_anti").select("*", F.array(*[F.lit(x).cast("long") for x in AT_END]).alias("end"), one)
    through = _arrow(alone, functools.partial(walk, True, [NOTHING]), schema, columns)
    # the same by way of distances between the ends of pieces, and of one way through for each state
    cut = _joined(pieces, several, ["conv_id"])
    cut = written(_joined(cut, _ends(cut), ["conv_id", "piece"]).withColumn("entry", one), "cut")
    final = F.col("piece") == F.col("final")
    ways = [_arrow(cut.where(c), functools.partial(walk, last, range(STATES)), schema, columns) for c, last in ((final, True), (~final, False))]
    ways = written(ways[0].union(ways[1]), "ways")
    return through.union(_joined(ways, _entered(ways), ["conv_id", "piece", "entry"]))


def repaired(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(report, repaired turns) of conversations; ``rows`` has conv_id, turn, role, text without nulls but in ids and turns.

    The turns of the second: conv_id, pos, at (their order), turn (null if inserted), role, text,
    edit. The first has one row a conversation: gaps, blank, duplicate, truncated, illegal, cost,
    audit. Rows of one turn are ordered by role and text; repeated rows count as copies; rows
    without conv_id are one conversation. Roles count by their initial; a row of another or no
    initial cannot be kept as it is. gaps is null beyond 64 bits. An empty table gives empty ones.
    """
    turns = _ordered(rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text"))
    coded = written(_coded(turns), "coded")
    pieces = written(_pieces(coded), "pieces")
    edits = written(_joined(_edits(pieces), pieces.select("conv_id", "piece", "first", "initials"), ["conv_id", "piece"]), "edits")

    count = lambda c: F.count(F.when(c, 1))
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    facts = coded.groupBy("conv_id").agg(
        F.min("turn").alias("low"),
        F.max("turn").alias("high"),
        F.count_distinct("turn").alias("turns"),
        count(F.col("code") == BLANK).alias("blank"),
        count(F.col("code") == COPY).alias("duplicate"),
        count(F.col("code").isin("S", "U", "A", "O")).alias("truncated"),
    )
    gaps = F.when(F.col("low").isNull(), F.lit(0).cast("long")).otherwise((wide("high") - wide("low") + 1 - F.col("turns")).try_cast("long"))
    facts = facts.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated")

    odd = lambda a, b: ~F.concat(a, b).isin("su", "ua", "au")
    pairs = lambda xs, a, b: F.size(F.filter(F.sequence(F.lit(1), F.size(xs) - 1), lambda i: odd(a(i), b(i))))
    inside = F.when(F.size("initials") < 2, 0).otherwise(pairs(F.col("initials"), lambda i: F.col("initials")[i - 1], lambda i: F.col("initials")[i]))
    ends = F.struct("piece", "cost", "audit", inside.alias("odd"), F.col("initials")[0].alias("head"), F.element_at("initials", -1).alias("tail"))
    held = edits.groupBy("conv_id").agg(F.array_sort(F.collect_list(ends)).alias("held"))
    across = F.when(F.size("held") < 2, 0).otherwise(pairs(F.col("held"), lambda i: F.col("held")[i - 1]["tail"], lambda i: F.col("held")[i]["head"]))
    held = held.select(
        "conv_id",
        (F.aggregate("held", F.lit(0), lambda a, x: a + x["odd"]) + across).cast("long").alias("illegal"),
        F.col("held")[0]["cost"].alias("cost"),
        F.array_join("held.audit", "").alias("audit"),
    )
    report = _joined(facts, held, ["conv_id"])

    letters = F.arrays_zip(F.split("audit", "").alias("edit"), F.split("roles", ",", -1).alias("written"), F.col("rows").alias("row"))
    each = edits.where("audit <> ''").select("conv_id", "first", F.posexplode(letters).alias("at", "x"))
    each = each.select("conv_id", (F.col("first") + F.col("x.row")).alias("pos"), "at", F.col("x.edit").alias("edit"), F.col("x.written").alias("written"))
    texts = turns.select(F.col("pos").alias("own"), "turn", "role", "text")
    used = each.where("edit <> 'D'").join(texts, (F.col("pos") == F.col("own")) & (F.col("edit") != "I"), "left")
    role = F.when(F.col("edit") == "K", F.col("role")).otherwise(F.col("written"))
    return report, used.select("conv_id", "pos", "at", "turn", role.alias("role"), F.coalesce("text", F.lit("")).alias("text"), "edit")


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of repaired turns: of ``role:text``, joined by newlines.

    A conversation's turns stream past one hash in order, a batch at a time.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        names, sums, key, going = [], [], None, None
        for batch in batches:
            ids, lines = batch.column(0), batch.column(1).to_pylist()
            for j, line in enumerate(lines):
                own = ids[j].as_py()
                if going is None or own != key:
                    if going is not None:
                        sums.append(going.hexdigest())
                    key, going = own, hashlib.sha256()
                    names.append(own)
                else:
                    going.update(b"\n")
                going.update(line.encode())
            if len(sums) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(names[: len(sums)], ids.type), pa.array(sums, pa.string())], names=["conv_id", "repaired_sha256"])
                names, sums = names[len(sums) :], []
        if going is not None:
            sums.append(going.hexdigest())
            yield pa.RecordBatch.from_arrays([pa.array(names, ids.type), pa.array(sums, pa.string())], names=["conv_id", "repaired_sha256"])

    lines = turns.select("conv_id", "pos", "at", F.concat("role", F.lit(":"), "text").alias("line"))
    lines = lines.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "at")
    return lines.select("conv_id", "line").mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def repair_report(conversations: DataFrame) -> DataFrame:
    """One row for each conv_id of ``conversations``, after the damage of :func:`damaged`.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256; zeros, an empty
    audit and the hash of nothing where no row is left. See :func:`repaired` for the rest.
    """
    report, turns = repaired(damaged(conversations))
    ids = conversations.select("conv_id").distinct()
    every = _joined(_joined(ids, report, ["conv_id"], "left"), digests(turns), ["conv_id"], "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    gone = F.col("blank").isNull()
    none: Column = F.lit(hashlib.sha256(b"").hexdigest())
    return every.select(
        "conv_id",
        *[F.when(gone, F.lit(0).cast("long")).otherwise(F.col(c)).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", none).alias("repaired_sha256"),
    )


def without_faults(conversations: DataFrame) -> DataFrame:
    """``conversations`` repaired as they are, without damage: conv_id, place (from 0), turn, role, text, edit.

    Nulls in a role or text count as one space.
    """
    own = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    _, turns = repaired(conversations.select("conv_id", "turn", *own))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("pos", "at")) - 1
    return turns.select("conv_id", place.alias("place"), "turn", "role", "text", "edit")


def _crc_sql(text: str) -> str:
    """CRC-32 of an ASCII text in DuckDB, half a byte at a time."""
    table = []
    for x in range(16):
        for _ in range(4):
            x = (x >> 1) ^ (0xEDB88320 if x & 1 else 0)
        table.append(x)
    half = f"xor(a >> 4, ([{', '.join(map(str, table))}]::BIGINT[])[1 + (xor(a, {{}}) & 15)])"
    bytes_of = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    halves = f"flatten(list_transform({bytes_of}, lambda b: [b & 15, b >> 4]))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {halves}), lambda a, b: {half.format('b')}), 4294967295::BIGINT)"


def _least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _add(way: str, cost: str, name: str) -> str:
    return f"{{'c': {way}.c + {cost}, 't': {way}.t || '{name}'}}"


def _repair_sql() -> str:
    """The same in DuckDB: costs and audits of the four states, row after row, inserting before each."""
    i = lambda way, n=1: _add(way, f"{INSERT * n}", "I" * n)
    far = f"{{'c': {FAR}, 't': ''}}"
    closed = {"z": "z", "s": "s", "u": _least("u", i("z"), i("s"), i("a")), "a": _least("a", i("u"), i("z", 2), i("s", 2))}
    kept = lambda way, role: f"CASE WHEN fine AND role[1] = '{role}' THEN {_add(way, 'cut', 'K')} ELSE {far} END"
    changed = lambda way: f"CASE WHEN fine THEN {_add(way, f'{REROLE} + cut', 'R')} ELSE {far} END"
    gone = lambda way: _add(way, str(DELETE), "D")
    step = {
        "z": gone("z"),
        "s": _least(gone("s"), kept("z", "s")),
        "u": _least(gone("u"), *[f(x) for x in "zsa" for f in (lambda w: kept(w, "u"), changed)]),
        "a": _least(gone("a"), kept("u", "a"), changed("u")),
    }
    into = ", ".join(f"{v} AS {k}" for k, v in closed.items())
    over = ", ".join(f"{v} AS {k}" for k, v in step.items())
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return rf"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS k
  FROM conversations
), dam AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS time
  FROM src WHERE k <> 0
), num AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, rtrim(text, {white}) AS body FROM dam
), rows AS (
  SELECT *, body = '' AS is_blank, body <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS is_copy,
         lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS was
  FROM num
), coded AS (
  SELECT *, NOT is_blank AND NOT is_copy AS fine, NOT is_blank AND NOT is_copy AND right(body, 1) NOT IN ('.', '!', '?') AS is_cut FROM rows
), per AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (is_blank) AS blank,
         count(*) FILTER (is_copy) AS duplicate, count(*) FILTER (is_cut) AS truncated,
         count(*) FILTER (i > 1 AND was || role[1] NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM coded GROUP BY conv_id
), dp AS (
  SELECT conv_id, n, CAST(0 AS BIGINT) AS i, {{'c': CAST(0 AS BIGINT), 't': ''}} AS z, {{'c': CAST({FAR} AS BIGINT), 't': ''}} AS s,
         {{'c': CAST({FAR} AS BIGINT), 't': ''}} AS u, {{'c': CAST({FAR} AS BIGINT), 't': ''}} AS a
  FROM per
  UNION ALL
  SELECT conv_id, n, i, {over} FROM (
    SELECT b.conv_id, b.n, c.i, c.role, c.fine, CASE WHEN is_cut THEN {TRUNCATED} ELSE 0 END AS cut, {into}
    FROM dp b JOIN coded c ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND c.i = b.i + 1)
), best AS (
  SELECT conv_id, {_least("z", "a", i("u"), i("s", 2))} AS w FROM dp WHERE i = n
), letters AS (
  SELECT conv_id, p, w.t[p] AS e, string_split(regexp_replace(w.t[:p - 1], 'I', '', 'g'), '') AS before
  FROM (SELECT conv_id, w, unnest(range(1, len(w.t) + 1)) AS p FROM best)
), lines AS (
  SELECT l.conv_id, p, e, c.role, coalesce(CASE WHEN e <> 'I' THEN c.text END, '') AS text
  FROM letters l LEFT JOIN coded c ON l.conv_id IS NOT DISTINCT FROM c.conv_id
   AND e <> 'I' AND c.i = len(array_to_string(before, '')) + 1
  WHERE e <> 'D'
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY p) AS k, first_value(e = 'K' AND role[1] = 's') OVER (PARTITION BY conv_id ORDER BY p) AS has_system
  FROM lines
), joined AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN (k + CAST(has_system AS INTEGER)) % 2 = 1 THEN 'user' ELSE 'assistant' END
                                    || ':' || text, chr(10) ORDER BY p)) AS h
  FROM placed GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(w.c, 0) AS BIGINT) AS cost,
       coalesce(w.t, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN per p ON o.conv_id IS NOT DISTINCT FROM p.conv_id
LEFT JOIN best b ON o.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN joined j ON o.conv_id IS NOT DISTINCT FROM j.conv_id
"""


REPAIR_SQL = _repair_sql()
