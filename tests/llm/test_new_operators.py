"""Conversation repair, whitening and exact dedup against plain versions, nulls, ties, empty tables, clashing names."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from veritrail.llm import conversations, copies, whitening

KIND = "conv_id long, turn long, role string, text string, pos long, code string, first int"


# ---- conversations ---------------------------------------------------------


def _plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        case = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        out += [(conv, turn, "user" if case == 4 else role, text)] * (0 if case == 0 else 2 if case == 3 else 1)
    return out


def _plain_faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        found.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def _plain_repair(rows, faults):
    """Every edit script with at most two turns inserted in one place, by trial."""
    fills = [[], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]]
    best = None
    uses = [["D"] if f in ("blank", "duplicate") else ["D", "K", "user", "assistant"] for f in faults]
    for script in itertools.product(*[x for u in uses for x in (fills, u)], fills):
        cost, audit, lines = 0, "", []
        for k, step in enumerate(script):
            if k % 2 == 0:
                cost, audit = cost + 3 * len(step), audit + "I" * len(step)
                lines += [f"{r}:" for r in step]
                continue
            _, role, text = rows[k // 2]
            cost += (4 if step == "D" else 0 if step == "K" else 3) + (3 if step != "D" and faults[k // 2] == "truncated" else 0)
            audit += step if step in "DK" else "R"
            if step != "D":
                lines.append(f"{role if step == 'K' else step}:{text}")
        if re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines)) and (best is None or (cost, audit) < best[:2]):
            best = cost, audit, lines
    return best


def _plain_report(rows):
    want = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in _plain_damage([x for x in rows if x[0] == conv])), key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))
        faults = _plain_faults(mine)
        cost, audit, lines = _plain_repair(mine, faults)
        turns = [t for t, _, _ in mine if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(mine)]
        want[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(x) for x in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return want


def _rows(seed, convs=40, most=4):
    rng, rows = random.Random(seed), []
    for conv in [*range(convs), None]:
        for turn in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "umbrella"])
            text = rng.choice(["Yes.", "No!", "why", "so, ", "\t ", "", None, "Done?\n", "a. b"])
            rows.append((conv, rng.choice([turn, turn, turn * 3, None, 1]), role, text))
    return rows


@pytest.mark.parametrize("bits", [conversations.PIECE_BITS, 0, 1])
def test_repair_against_trial(spark, monkeypatch, bits):
    """Also with pieces of one and of two turns: conversations then meet in the distances between pieces."""
    monkeypatch.setattr(conversations, "PIECE_BITS", bits)
    rows = _rows(bits, most=3)
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], KIND)
    got = {r["conv_id"]: tuple(r)[1:] for r in conversations.repair_report(table).collect()}
    assert got == _plain_report(rows)


def test_long_conversation_in_pieces(spark, monkeypatch):
    """One conversation of most rows: the same answer from one piece and from many."""
    rng = random.Random(5)
    rows = [(1, k, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "cut off", f"Turn {k}."])) for k in range(300)]
    table = spark.createDataFrame(rows + [(2, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    whole = sorted(map(tuple, conversations.repair_report(table).collect()))
    monkeypatch.setattr(conversations, "PIECE_BITS", 3)
    assert sorted(map(tuple, conversations.repair_report(table).collect())) == whole
    audit = whole[0][7]
    assert len(audit.replace("I", "")) == len(_plain_damage(rows)) and whole[0][6] > 0


def test_repaired_turns_and_empty_table(spark):
    rows = [(1, 0, "user", "Hello."), (1, 1, "user", "Again."), (1, 2, "assistant", "Yes."), (1, 3, None, " ")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = [(r["place"], r["role"], r["text"], r["edit"]) for r in conversations.without_faults(table).orderBy("place").collect()]
    assert got == [(0, "user", "Hello.", "K"), (1, "assistant", "", "I"), (2, "user", "Again.", "K"), (3, "assistant", "Yes.", "K")]
    assert conversations.repair_report(table.limit(0)).count() == 0
    assert conversations.without_faults(table.limit(0)).count() == 0


def test_distances_are_shortest():
    """Dial's distances against relaxation until nothing changes."""
    rng = random.Random(6)
    for _ in range(60):
        codes = "".join(rng.choice("suaoSUAObd") for _ in range(rng.randint(0, 9)))
        end = tuple(rng.choice([0, 3, 6, 11, conversations.FAR]) for _ in range(4))
        far = [[conversations.FAR] * 4 for _ in range(len(codes))] + [list(end)]
        for i in range(len(codes) - 1, -1, -1):
            for _ in range(4):
                for q in range(4):
                    ways = [c + far[i + 1][to] for _, c, to in conversations._steps(codes[i], q)] + [3 + far[i][conversations.WRITTEN[q][1]]]
                    far[i][q] = min(far[i][q], *ways)
        assert [[min(x, conversations.FAR) for x in r] for r in conversations.distances(codes, end)] == [[min(x, conversations.FAR) for x in r] for r in far]


# ---- whitening -------------------------------------------------------------


def _plain_whitening(vectors, k=4):
    fine = [[float(c) for c in v] for v in vectors if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    dims = max(map(len, fine))
    x = np.floor(256 * np.array([v + [0.0] * (dims - len(v)) for v in fine])).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    cov = centred.T @ centred / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    return n, ((n * x - sums) ** 2).sum(axis=1), (x - sums / n) @ v / np.sqrt(e), e / np.trace(cov)


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(300, 6)) @ np.diag([5, 3, 2, 1, 0.5, 0.2]) + 7).astype(np.float32).tolist()
    vectors += vectors[:40] * 3 + [vectors[0][:4], None, [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [float("inf")] + [0.0] * 5]
    table = spark.createDataFrame([(i if i else None, v, "x") for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, x string").repartition(5)
    n, deviation, white, explained = _plain_whitening(vectors)
    got = whitening.whitened(table).collect()
    assert len(got) == 4 * len(deviation) and {r["n"] for r in got} == {n}
    by = {(r["vec_id"] or 0, r["component"]): r for r in got}
    for i in range(len(deviation)):
        assert by[i, 1]["deviation"] == deviation[i]
    for c in range(4):
        mine = np.array([by[i, c + 1]["whitened"] for i in range(len(deviation))])
        sign = np.sign(mine @ white[:, c])
        assert np.abs(mine * sign - white[:, c]).max() < 1e-9
        assert abs(by[0, c + 1]["explained"] / explained[c] - 1) < 1e-9
    assert len({r["identity_error"] for r in got}) == 1 and 0 <= got[0]["identity_error"] < 1e-9


def test_whitening_at_the_edges(spark):
    kind = "vec_id long, embedding array<double>"
    run = lambda rows: whitening.whitened(spark.createDataFrame(rows, kind)).orderBy("vec_id", "component").collect()
    assert run([]) == [] and run([(1, None), (2, [])]) == []
    one = run([(1, [1.0, 2.0]), (2, [1.0, 2.0])])  # nothing varies
    assert [(r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"]) for r in one] == [(v, c, 1, 0, None, None) for v in (1, 2) for c in (1, 2)]
    flat = run([(1, [0.0, 3.0]), (2, [2.0, 3.0])])  # one dimension of two varies
    assert [r["whitened"] for r in flat if r["component"] == 2] == [None, None]
    assert sorted(round(r["whitened"], 12) for r in flat if r["component"] == 1) == [-1.0, 1.0] and flat[0]["explained"] == 1.0
    far = run([(1, [1e300]), (2, [-1e300]), (3, [0.0])])  # beyond 64 bits
    assert [r["deviation"] for r in far] == [None, None, 1] and all(np.isfinite(r["whitened"]) for r in far)


# ---- exact dedup -----------------------------------------------------------


def _plain_copies(rows):
    form = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(form(t), []).append(i)
    keep = {t: min(ids, key=lambda i: (i is None, i or 0)) for t, ids in groups.items()}
    rest = [(i, keep[form(t)], len(groups[form(t)]), hashlib.sha256(form(t).encode()).hexdigest()) for i, t in rows]
    return sorted(rest, key=str), sorted(map(str, keep.values()))


@pytest.mark.parametrize("bits", [copies.MOST_BITS, 8])
@pytest.mark.parametrize("large", [copies.LARGE, 3])
def test_copies_against_plain(spark, monkeypatch, bits, large):
    """A filter of eight positions is full, so all rows are looked at; groups joined by broadcast and by shuffle."""
    monkeypatch.setattr(copies, "LARGE", large)
    rng = random.Random(8)
    rows = [(rng.choice([k, 3, None]), rng.choice(["", None, " ", "\t\n", "a b", "a  b", "a b", f"own {k}", "same " * 9000, "hot", "hot"])) for k in range(400)]
    table = spark.createDataFrame([(*r, 0, "s") for r in rows], "doc_id long, text string, row int, sha string").repartition(4)
    got = copies.exact_copies(table, most_bits=bits).collect()
    want, kept = _plain_copies(rows)
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=str) == want
    assert sorted(str(r["doc_id"]) for r in got if r["kept"]) == kept
    left = copies.without_copies(table)
    assert left.columns == table.columns and sorted(str(r["doc_id"]) for r in left.collect()) == kept


def test_copies_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string, _row int")
    assert copies.exact_copies(none).count() == 0 and copies.without_copies(none).columns == none.columns


def test_unique_rows_are_not_shuffled(spark):
    """Rows with a position hit once are no candidates: few others than copies are."""
    rows = [(k, f"text {k}") for k in range(3000)] + [(5000 + k, "again") for k in range(50)]
    texts = spark.createDataFrame(rows, "id long, text string").selectExpr("id", "id AS row", "sha2(text, 256) AS sha")
    bits = 1 << 16
    maybe = copies._looked_up(texts, copies._hit_twice(texts, bits), bits).where("maybe")
    assert 50 <= maybe.count() < 200 and maybe.where("id >= 5000").count() == 50
    plan = copies.exact_copies(spark.createDataFrame(rows, "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
