"""Whitening, conversation repair and nearest neighbours against plain versions, with their edge cases."""

import hashlib
import itertools
import zlib
from heapq import heappop, heappush

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.llm import forest, repair, whiten

CLASHING = ("vector", "cls", "head", "ids", "cell", "side", "q", "rank", "score", "n", "component", "place", "v", "mark", "first", "copies", "later", "c", "r", "m", "code", "k")


def clash(df):
    return df.select("*", *[F.lit(f"kept {c}").alias(c) for c in CLASHING if c not in df.columns])


def vectors(spark, rows, kind="float"):
    return clash(spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows], f"vec_id long, embedding array<{kind}>"))


# --- whitening ---

@pytest.mark.parametrize("kind", ["float", "double"])
def test_whitening_against_numpy(spark, kind):
    r = np.random.default_rng(2)
    a = (r.standard_normal((300, 40)) @ r.standard_normal((40, 40)) + 3).astype(np.float32)
    rows = [(k, v) for k, v in enumerate(a)] + [(7, a[7]), (None, a[8])]
    odd = [(900, None), (901, [None] + [1.0] * 39), (902, [float("nan")] + [1.0] * 39), (903, [float("-inf")] + [1.0] * 39), (904, [1.0]), (905, [])]
    got = whiten.whitened_embeddings(vectors(spark, rows + odd, kind)).toPandas()
    assert len(got) == 302 * 32 and set(got.n) == {302}
    x = np.floor(64 * np.vstack([a, a[7:9]]).astype(float)) + 1_000_000
    e, u = np.linalg.eigh(np.cov(x.T, bias=True))
    e, u = e[::-1], u[:, ::-1]
    y = (x - x.mean(axis=0)) @ u[:, :32] / np.sqrt(e[:32])
    for k in (1, 9, 32):
        part = got[(got.component == k) & got.vec_id.notna()].sort_values("vec_id").drop_duplicates("vec_id")
        want = y[:300, k - 1]
        assert np.allclose(part.whitened * np.sign(part.whitened.iloc[0] * want[0]), want, atol=1e-6)
        assert np.allclose(part.explained, e[k - 1] / e.sum(), rtol=1e-9)
    ints = [[int(v) for v in row] for row in x]
    s = [sum(c) for c in zip(*ints, strict=True)]
    far = {k: sum((302 * v - t) ** 2 for v, t in zip(ints[k], s, strict=True)) for k in range(300)}
    assert all(far[int(i)] == d for i, d in zip(got.vec_id, got.deviation, strict=True) if i == i)
    assert got.identity_error.nunique() == 1 and got.identity_error.max() < 1e-9
    assert len(got[got.vec_id.isna()]) == 32 and len(got[got.vec_id == 7]) == 64


def test_whitening_without_rows_or_variance(spark):
    assert whiten.whitened_embeddings(vectors(spark, [(1, None)])).count() == 0
    assert whiten.whitened_embeddings(vectors(spark, [(1, [0.5])]).filter("false")).count() == 0
    same = whiten.whitened_embeddings(vectors(spark, [(1, [0.5, 2]), (2, [0.5, 2])])).collect()
    assert len(same) == 4 and all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in same)
    part = whiten.whitened_embeddings(vectors(spark, [(k, [k, 2 * k, 5]) for k in range(50)])).collect()
    assert {r.component for r in part if r.whitened is None} == {2, 3} and max(r.identity_error for r in part) < 1e-9


def test_jacobi_keeps_small_eigenvalues():
    r = np.random.default_rng(4)
    base = r.standard_normal((12, 12))
    well = base @ base.T + 12 * np.eye(12)
    scale = 10.0 ** -np.arange(12)
    a = well * np.outer(scale, scale)
    e, u = whiten.jacobi(a)
    assert np.allclose(u.T @ u, np.eye(12), atol=1e-13) and np.allclose(u @ np.diag(e) @ u.T, a, atol=1e-13)
    from fractions import Fraction  # the determinant, exactly, is the product of the eigenvalues
    m = [[Fraction(x) for x in row] for row in a]
    det = Fraction(1)
    for i in range(12):
        det *= m[i][i]
        for j in range(i + 1, 12):
            f = m[j][i] / m[i][i]
            m[j] = [x - f * y for x, y in zip(m[j], m[i], strict=True)]
    assert abs(float(np.prod(e / scale ** 2)) / float(det / np.prod([Fraction(x) ** 2 for x in scale])) - 1) < 1e-9


def test_totals_beyond_a_long():
    t, want = whiten.Totals(2), [0, 0]
    for k in range(40):
        x = np.array([(1 << 60) + k, -(1 << 59)], np.int64)
        t.add(x, 1 << 60)
        want = [a + int(b) for a, b in zip(want, x, strict=True)]
    assert t.sums().tolist() == want
    big = np.array([[1 << 40, 3], [-(1 << 40), 5]], np.int64)
    upper, _ = whiten.products(big)
    assert [int(x) for x in upper] == [1 << 81, -(2 << 40), 34]


# --- repair ---

def plain_repair(rows):
    """Cheapest edits by trying everything, in order of (cost, audit); rows: role, text, fault."""
    queue, seen = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, roles, turns = heappop(queue)
        if (audit, roles) in seen:
            continue
        seen.add((audit, roles))
        body = roles.removeprefix("s")
        legal = not roles or (body and len(body) % 2 == 0 and body == "ua" * (len(body) // 2))
        if i == len(rows) and legal:
            return cost, audit, "\n".join(f"{a}:{b}" for a, b in turns)
        if not all(x in ("su", "ua", "au") for x in map("".join, itertools.pairwise(roles))) or roles[:1] == "a" or set(roles) - set("sua"):
            continue
        for role in ("user", "assistant"):
            if not audit.endswith("III"):
                heappush(queue, (cost + 5, audit + "I", i, roles + role[0], turns + ((role, ""),)))
        if i < len(rows):
            role, text, fault = rows[i]
            heappush(queue, (cost + 2, audit + "D", i + 1, roles, turns))
            if fault != repair.MUST_GO:
                more = 5 if fault == repair.CUT else 0
                if role:
                    heappush(queue, (cost + more, audit + "K", i + 1, roles + role[0], turns + ((role, text),)))
                for to in ("user", "assistant"):
                    heappush(queue, (cost + 1 + more, audit + "R", i + 1, roles + to[0], turns + ((to, text),)))


def plain_result(rows):
    """rows: turn, role, text with damage, sorted."""
    faults, seen, counts = [], set(), {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        solid = text.strip(" \t\n\x0b\x0c\r")
        name = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        seen.add((role, text))
        if name:
            counts[name] += 1
        faults.append((role, text, {"": repair.FINE, "truncated": repair.CUT}.get(name, repair.MUST_GO)))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit, text = plain_repair(faults)
    return {"gaps": gaps, **counts, "illegal": illegal, "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256(text.encode()).hexdigest()}


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if code == 1 else "".join(c for c in text if c not in ".!?") if code == 2 else text
        out += [(conv, turn, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return out


def made_conversations(n=120):
    r = np.random.default_rng(5)
    texts = ["Fine.", "Why?", "cut off", "", " \t", "Again.", None, "end!\n", "a.b"]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "supervisor"]
    rows = []
    for conv in range(n):
        size = int(r.integers(0, 8)) or 1
        for t in r.permutation(9)[:size]:
            rows.append((conv if conv else None, None if r.random() < 0.08 else int(t) - 2, roles[int(r.integers(0, len(roles) if conv % 3 else 2))], texts[int(r.integers(0, len(texts)))]))
    return rows + rows[:9]


@pytest.mark.parametrize(("segment", "damage"), [(512, True), (512, False), (1, False), (3, True)])
def test_repair_against_trying_everything(spark, monkeypatch, segment, damage):
    rows = made_conversations()
    df = clash(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    monkeypatch.setattr(repair, "SEGMENT", segment)
    made = plain_damage(rows) if damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    source = repair.damaged(df) if damage else df.drop("copies").select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.lit(1).alias("copies"))
    # worker processes may keep the usual segment; the lines below search here, by the small one
    got = {r.conv_id: r.asDict() for r in repair.repair(source).collect()}
    assert set(got) == {c for c, _, _, _ in rows}
    for conv in got:
        mine = sorted(((t, r, x) for c, t, r, x in made if c == conv), key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        want = plain_result(mine)
        assert {k: got[conv][k] for k in want} == want
        talk, equal = repair.Conversation(), {}
        for t, r, x in mine:
            later = (r, x) in equal and equal[(r, x)] != t
            equal.setdefault((r, x), t)
            talk.add(t, r, x, later)
        assert talk.result() == (*[want[k] for k in repair.COUNTS], want["audit"], want["repaired_sha256"])


def test_repair_without_rows_and_of_long_conversations(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert repair.repair(repair.damaged(spark.createDataFrame([], schema))).count() == 0
    gone = next(t for t in range(100) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    (row,) = repair.repair(repair.damaged(spark.createDataFrame([(5, gone, "user", "x.")], schema))).collect()
    assert (row.cost, row.audit, row.repaired_sha256) == (0, "", hashlib.sha256(b"").hexdigest())
    many = [(1, k, ("user", "assistant")[k % 2], f"word {k}.") for k in range(3_000)]
    (row,) = repair.repair(spark.createDataFrame(many, schema).withColumn("copies", F.lit(1))).collect()
    assert row.audit == "K" * 3_000 and row.cost == 0
    assert row.repaired_sha256 == hashlib.sha256("\n".join(f"{r}:{x}" for _, _, r, x in many).encode()).hexdigest()


# --- nearest neighbours ---

def plain_nearest(rows, every, top=forest.TOP):
    x = {}
    for i, v in rows:
        x.setdefault(i, []).append(np.array(v, float))
    out = {}
    for q in x:
        if q % every == 0:
            near = sorted((-max(float((a * b).sum()) for a in x[q] for b in x[c]), c) for c in x if c != q)
            out[q] = [(c, -s) for s, c in near[:top]]
    return out


def test_forest_with_one_leaf_is_exact(spark):
    r = np.random.default_rng(6)
    a = np.round(r.standard_normal((90, 6)), 1)
    a[10:50] = a[10]  # copies, and ties of products
    rows = [(k, v) for k, v in enumerate(a) if np.any(v)] + [(100, 5 * a[3]), (100, 5 * a[3]), (101, a[5]), (101, a[6])]
    odd = [(200, None), (220, [0.0] * 6), (240, [None] * 6), (260, [float("nan")] * 6), (280, [1.0]), (None, a[0])]
    got = {}
    for x in forest.nearest(vectors(spark, rows + odd, "double"), every=5).collect():
        got.setdefault(x.query_id, []).append((x["rank"], x.vec_id, x.score))
    want = plain_nearest(rows, 5)
    assert set(got) == set(want)
    for q, near in got.items():
        near.sort()
        assert [k for k, _, _ in near] == list(range(1, len(want[q]) + 1))
        assert [i for _, i, _ in near] == [i for i, _ in want[q]] and np.allclose([s for _, _, s in near], [s for _, s in want[q]], atol=1e-12)


def test_forest_few_or_no_candidates(spark):
    assert forest.nearest(vectors(spark, [(0, None)])).count() == 0 and forest.nearest(vectors(spark, [(0, [1.0])])).count() == 0
    assert [tuple(r) for r in forest.nearest(vectors(spark, [(0, [1.0, 0]), (3, [0.5, 0])])).collect()] == [(0, 1, 3, 0.5)]


@pytest.mark.parametrize(("clusters", "tile"), [(0, 4096), (40, 4096), (40, 32)])
def test_forest_recall(spark, monkeypatch, clusters, tile):
    r = np.random.default_rng(7)
    monkeypatch.setattr(forest, "TILE", tile)
    a = r.standard_normal((3_000, 24)) * (0.2 if clusters else 1)
    if clusters:
        a += r.standard_normal((clusters, 24))[r.integers(0, clusters, 3_000)]
    a[::7] *= 3
    rows = list(enumerate(a))
    got = {}
    for x in forest.nearest(vectors(spark, rows, "double"), leaf=64).collect():
        got.setdefault(x.query_id, set()).add(x.vec_id)
    want = plain_nearest(rows, 20)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert sum(len(got[q] & {i for i, _ in want[q]}) for q in want) / (20 * len(want)) >= 0.9


def test_leaves_come_likeliest_first_and_all_of_them():
    r = np.random.default_rng(8)
    x = r.standard_normal((2_000, 10))
    f = forest.plant(x, float(np.linalg.norm(x, axis=1).max()), len(x), leaf=64)
    assert f.depth == 5 and np.bincount(f.leaves_of(x)[:, 0], minlength=32).min() >= 40
    left, right = f.splits(x[:3], 0.5)
    order = list(f.visit(left[0].tolist(), right[0].tolist()))
    assert sorted(order) == list(range(4 * 32))
    price = {}
    for t in range(4):
        for leaf in range(32):
            k, cost = leaf + 31, 0.0
            while k:
                up = (k - 1) // 2
                cost -= (left if k == 2 * up + 1 else right)[0][t][up]
                k = up
            price[t * 32 + leaf] = cost
    assert all(price[a] <= price[b] + 1e-9 for a, b in itertools.pairwise(order))
