"""Conversation repair, periodic runs and embedding graphs against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from loamgrid.llm import conversations, embeddings, periodic, registry

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def collect(df):
    return sorted(map(tuple, df.collect()), key=repr)


# conversations


def cheapest(codes):
    """(cost, audit) over every string of the grammar, by recursion."""
    best, n = None, len(codes)
    for size in [0, *range(2, 2 * n + 4)]:
        goal = ("s" if size % 2 else "") + "ua" * (size // 2)
        seen = {}

        def rest(i, j):
            if (i, j) not in seen:
                ways = [(0, "")] if i == n and j == size else []
                c = codes[i] if i < n else ""
                t = goal[j] if j < size else ""
                if c:
                    ways.append((rest(i + 1, j)[0] + 3, "D" + rest(i + 1, j)[1]))
                if t and t != "s":
                    ways.append((rest(i, j + 1)[0] + 2, "I" + rest(i, j + 1)[1]))
                if c and t and c != "d":
                    cost, audit = rest(i + 1, j + 1)
                    if c.lower() == t:
                        ways.append((cost + c.isupper(), "K" + audit))
                    if t != "s":
                        ways.append((cost + 2 + c.isupper(), "R" + audit))
                seen[i, j] = min(ways) if ways else (10**6, "")
            return seen[i, j]

        best = min(best, rest(0, 0)) if best else rest(0, 0)
    return best


def plain_repair(rows):
    """The result for one conversation's rows (turn, role, text), by the contract."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults, codes = set(), Counter(), []
    for _, role, text in rows:
        fault = "blank" if not WORD.search(text) else "duplicate" if (role, text) in seen else "truncated" if WORD.findall(text)[-1][-1] not in ".!?" else None
        seen.add((role, text))
        faults[fault] += 1
        code = role[:1] if role[:1] and role[:1] in "sua" else "x"
        codes.append("d" if fault in ("blank", "duplicate") else code.upper() if fault else code)
    cost, audit = cheapest("".join(codes))
    goal, out, i = ("s" if (len(audit) - audit.count("D")) % 2 else "") + "ua" * len(audit), [], 0
    for letter in audit:
        if letter == "D":
            i += 1
            continue
        name = {"s": "system", "u": "user", "a": "assistant"}[goal[len(out)]]
        if letter == "I":
            out.append(f"{name}:")
        else:
            out.append(f"{rows[i][1] if letter == 'K' else name}:{rows[i][2]}")
            i += 1
    turns = {r[0] for r in rows} - {None}
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest)


def talks(seed, n):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(r.choice([0, 1, 2, 4, 6, 9])):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "unset", None])
            text = r.choice(["Yes.", "no", "Well?\n", "", " \t", None, "a.b", "x! ", "Long " * 50 + "."])
            rows.append((c if c % 9 else None, r.choice([turn, turn, turn, None, turn + 3]), role, text))
    return rows


CONV = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("block", [256, 3])
def test_repair_against_recursion(spark, monkeypatch, block):
    """Blocks of three turns carry places in the grammar from one to the next."""
    monkeypatch.setattr(conversations, "BLOCK", block)
    rows = talks(block, 60)
    df = spark.createDataFrame(rows, CONV).repartition(3)
    groups = defaultdict(list)
    for c, turn, role, text in rows:
        groups[c].append((turn, " " if role is None else role, " " if text is None else text))
    # one task in this process, so that the block size holds
    got = {}
    for c, turn, role, text, _, fault in sorted(conversations.faulty(df).collect(), key=lambda r: (repr(r[0]), r[1] is not None, r[1] or 0, r[2], r[3], r[5] == "duplicate")):
        got.setdefault(c, conversations.Repair()).add(turn, role, text, fault)
    results = {c: tuple(x.result()) for c, x in got.items()}
    small = [c for c, g in groups.items() if len(g) < 13]  # the recursion is slow beyond
    assert len(small) > 30 and {c: results[c] for c in small} == {c: plain_repair(groups[c]) for c in small}
    assert {r[0]: tuple(r)[1:] for r in conversations.repair_conversations(df).collect()} == results


def test_align_finds_the_least_audit():
    r = random.Random(3)
    for _ in range(800):
        codes = "".join(r.choice(r.choice(["ua", "uasxUASXd", "uad"])) for _ in range(r.choice([0, 1, 2, 3, 5, 8])))
        found = conversations.align(codes, conversations.START)
        assert min(found[p] for p in conversations.ENDS if p in found) == cheapest(codes)


def test_a_long_conversation_goes_by_blocks(spark):
    """5,000 turns with few faults, a text of a million characters among them; what a task holds is one block."""
    rows = [(1, i, ("user", "assistant")[i % 2] if i % 97 else "system", f"turn {i}." if i != 70 else "w " * 500_000 + ".") for i in range(5000)]
    got = conversations.repair_conversations(spark.createDataFrame(rows, CONV)).first()
    assert got["gaps"] == got["blank"] == got["duplicate"] == got["truncated"] == 0 and set(got["audit"]) <= set("DIKR")
    assert got["cost"] <= 2 * sum(r[2] == "system" for r in rows)
    turns = conversations.repaired_turns(spark.createDataFrame(rows[:300], CONV)).orderBy("place").collect()
    initials = "".join(r["role"][0] for r in turns if r["role"])
    assert re.fullmatch("(s?(ua)+)?", initials) and hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in turns if r["role"]).encode()).hexdigest() == conversations.repair_conversations(spark.createDataFrame(rows[:300], CONV)).first()["repaired_sha256"]


def test_damage_and_dropped_conversations(spark):
    key = lambda c, t: zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
    rows = [(c, t, "assistant", f"Said. {c}!") for c in (*range(30), None) for t in (*range(6), None)]
    got = Counter((r.conv_id, r.turn, r.role, r.text, r.alive) for r in conversations.damage(spark.createDataFrame(rows, CONV)).collect())
    want = Counter()
    for c, t, role, text in rows:
        k = key(c, t)
        want[c, t, "user" if k == 4 else role, "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text, k != 0] += 2 if k == 3 else 1
    assert got == want
    gone = next(c for c in range(10_000) if key(c, 0) == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hi."), (gone, 0, None, None)], CONV)
    out = conversations.repair_conversations(conversations.damage(df), alive="alive").collect()
    assert [tuple(r) for r in out] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert conversations.repair_conversations(df.filter("false")).count() == 0


def test_op11_sql_on_awkward_rows(spark, tmp_path):
    rows = [(c, t, r, x) for c, t, r, x in talks(5, 80)]
    spark.createDataFrame(rows, CONV).coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    c = duckdb.connect()
    c.sql(f"CREATE VIEW conversations AS FROM '{tmp_path}/conversations.parquet/*.parquet'")
    df = conversations.op11_conversation_repair(spark, str(tmp_path))
    cols = sorted(df.columns)
    small = [k for k, n in Counter(r[0] for r in rows).items() if n < 12]
    keep = lambda rows: [r for r in rows if r[cols.index("conv_id")] in small]
    assert keep(collect(df.select(*cols))) == keep(sorted(c.sql(conversations.OP11_SQL).select(*cols).fetchall(), key=repr))


# periodic runs


def plain_runs(w, least=6, times=4):
    out = []
    for q in range(1, len(w) // times + 1):
        i = q
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            run = w[i - q : j]
            if len(run) >= max(least, times * q) and all(any(run[k] != run[k - p] for k in range(p, len(run))) for p in range(1, q)):
                out.append((i - q, len(run), q))
            i = max(i + 1, j)
    return sorted(out, key=lambda r: (r[0], r[2]))


def patterned(r, n):
    k, w = r.choice([1, 2, 3, 5]), []
    while len(w) < n:
        unit = [r.randrange(k) for _ in range(r.randint(1, 9))]
        w += unit * r.choice([1, 1, 3, 4, 5, 9]) + unit[: r.randrange(len(unit) + 1)]
    return [f"w{x}" for x in w[:n]]


def test_runs_against_every_period():
    r, found = random.Random(6), 0
    for _ in range(400):
        texts = [[x.encode() for x in patterned(r, r.choice([0, 1, 5, 6, 30, 90, 200]))] for _ in range(r.choice([1, 4]))]
        got = periodic.search(texts)
        assert got == [plain_runs(t) for t in texts]
        found += sum(map(len, got))
    assert found > 500


def test_periodic_runs_on_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(periodic, "TOGETHER", 50)
    r = random.Random(7)
    texts = [None, "", " \n\t ", "one", "a b c", "go " * 40, "x\ty\n" * 9 + "z", "é é é é é é", " ".join(patterned(r, 300)), " ".join(f"u{i}" for i in range(500)), "ab " * 350_000]
    rows = [(i, t, "k", i) for i, t in enumerate(texts)] + [(None, texts[5], None, None), (5, texts[5], "k", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, collapsed long")
    got = Counter((x.doc_id, tuple(map(tuple, x.runs)), x.collapsed) for x in periodic.periodic_runs(df).collect())
    want = Counter()
    for i, t, *_ in rows:
        w = WORD.findall(t or "")
        runs = plain_runs(w) if len(w) < 1000 else [(0, len(w), 1)]
        drop = {k for s, n, q in runs for k in range(s + q, s + n)}
        want[i, tuple(runs), " ".join(x for k, x in enumerate(w) if k not in drop)] += 1
    assert got == want
    assert periodic.periodic_runs(df.filter("false")).count() == 0


def test_op12_by_its_contract(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = {r.doc_id: r for r in registry.queries()["op12_periodic_runs"](spark, SF).collect()}
    assert out.keys() == docs.keys()
    damaged = 0
    for i, text in docs.items():
        w = WORD.findall(text or "")
        h = zlib.crc32(str(i).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
            damaged += 1
        if n > 1500:
            runs = sorted((s, m, q) for s, m, q in periodic.search([[x.encode() for x in w]])[0])  # compared with every period above
        else:
            runs = plain_runs(w)
        drop = {k for s, m, q in runs for k in range(s + q, s + m)}
        top = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=None)
        r = out[i]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *(top or (None,) * 3))
        assert r.exponent_milli == (1000 * top[1] // top[2] if top else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in sorted(runs, key=lambda x: (x[0], x[2]))).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in drop).encode()).hexdigest()
    assert damaged > 5


# embeddings


def plain_links(vectors, least=0.9):
    """Links and components over all pairs."""
    n = len(vectors)
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    unit = [np.array(v) / np.linalg.norm(v) if k else None for v, k in zip(vectors, ok)]
    link = [{j for j in range(n) if j != i and ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least} for i in range(n)]
    root = list(range(n))
    for _ in range(n):
        new = [min([root[i], *(root[j] for j in link[i])]) for i in range(n)]
        if new == root:
            break
        root = new
    return link, root


def test_graph_recall():
    """Every link of clusters of different density is found, or an audit has to widen the beam."""
    r = np.random.default_rng(4)
    parts = [r.standard_normal((700, 32))]
    for size, noise in ((3, 0.01), (40, 0.03), (400, 0.03)):
        for _ in range(3):
            parts.append(r.standard_normal((1, 32)) + noise * r.standard_normal((size, 32)))
    x = embeddings.units(np.concatenate(parts)[r.permutation(sum(map(len, parts)))]).astype(np.float32)
    levels = np.sort(np.floor(-np.log(r.random(len(x))) / np.log(16)).astype(int))[::-1]
    graph = embeddings.Graph.build(x, levels)
    true = x @ x.T >= 0.9
    beam = graph.audited_beam(0.9)
    found = 0
    for i in range(0, len(x), 512):
        a, b = graph.linked(x[i : i + 512], beam, 0.9)
        assert true[a + i, b].all() and len(set(zip(a.tolist(), b.tolist()))) == len(a)
        found += len(a)
    assert beam <= len(x) and found >= 0.995 * true.sum()
    graph.layers[0][:] = -1  # a graph without links fails every audit and is searched by brute force
    assert graph.audited_beam(0.9) > len(x)
    a, b = graph.linked(x[:100], len(x) + 1, 0.9)
    assert len(a) == true[:100].sum()


def test_embeddings_on_awkward_rows(spark):
    r = np.random.default_rng(5)
    near = [(r.standard_normal(6) * 0.05 + np.eye(6)[k % 3]).tolist() for k in range(60)]
    vectors = [None, [], [0.0] * 6, [float("nan"), *[1.0] * 5], [float("inf"), *[1.0] * 5], [None, *[1.0] * 5], [1.0, 0.0], [2.0, 0.0], [0.0, 3.0], near[0], near[0], [x * 1e200 for x in near[1]], *near, *r.standard_normal((40, 6)).tolist()]
    rows = [(i if i % 11 else None, v, "x", i) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node string, n_links int").repartition(3)
    link, root = plain_links([v if v is None else [x and (x / 1e200 if abs(x) > 1e100 and np.isfinite(x) else x) for x in v] for v in vectors])
    ids = [x[0] for x in rows]
    groups = defaultdict(list)
    for i, k in enumerate(root):
        groups[k].append(ids[i])
    want = Counter()
    for i in range(len(rows)):
        component = min((x for x in groups[root[i]] if x is not None), default=None)
        want[ids[i], len(link[i]), component, ids[i] is not None and ids[i] == component] += 1
    for shards in (1, 4):
        assert Counter(map(tuple, embeddings.similar_vectors(df, shards=shards).collect())) == want
    assert embeddings.similar_vectors(df.filter("false")).count() == 0


def test_op13_against_all_pairs(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    link, root = plain_links([list(map(float, r.embedding)) for r in rows])
    got = {r.vec_id: r for r in registry.queries()["op13_embedding_near_dedup"](spark, SF).collect()}
    for i, r in enumerate(rows):
        component = min(rows[k].vec_id for k in range(len(rows)) if root[k] == root[i])
        assert (got[r.vec_id].n_links, got[r.vec_id].component_id, got[r.vec_id].kept) == (len(link[i]), component, component == r.vec_id)
