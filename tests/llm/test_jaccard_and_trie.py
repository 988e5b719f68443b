"""The Jaccard join and the prefix trie against brute force."""

import collections
import hashlib
import random
import re
import string
import zlib

import pytest

from newslode.llm import conversation_trie, jaccard_join, queries

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1))))


def near_by_brute_force(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, (_, s) in enumerate(sets):
        for y in range(x):
            other = sets[y][1]
            if s and other and 100 * len(s & other) >= 80 * len(s | other):
                parent[top(x)] = top(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            least[top(x)] = min(i, least.get(top(x), i))
    return sorted(((i, len(s), least.get(top(x))) for x, (i, s) in enumerate(sets)), key=str)


def found(df):
    return sorted((tuple(r) for r in jaccard_join.near_sets(df).collect()), key=str)


@pytest.fixture(scope="module")
def copies(spark):
    """Chains of near copies, near copies that are not near each other, and texts that share one passage."""
    rng = random.Random(5)
    word = lambda: rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()) + str(rng.randrange(60))
    base = [word() for _ in range(120)]
    passage = [word() for _ in range(40)]
    rows = []
    for n in range(90):  # edits of one text, from none to many
        w = list(base)
        for _ in range(n % 9):
            w[rng.randrange(len(w))] = word()
        rows.append(" ".join(w))
    step = list(base)
    for _ in range(20):  # a chain: each near the one before
        step[rng.randrange(len(step))] = word()
        rows.append(" ".join(step))
    rows += [" ".join([word() for _ in range(80)] + passage) for _ in range(60)]
    rows += ["one", "One", "one two", "one two three four five", "a b c d e f", "NUL\x00 b c d e f", "é ü ß ñ ö ä"]
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("small, block, heavy", [(32, 2048, 32), (2, 7, 3), (1, 1024, 10**9)])
def test_links_by_brute_force(copies, monkeypatch, small, block, heavy):
    """With the usual limits, with groups cut to pieces, and with every token going to leaders and blocks."""
    for name, value in (("SMALL", small), ("BLOCK", block), ("HEAVY", heavy)):
        monkeypatch.setattr(jaccard_join, name, value)
    assert found(copies) == near_by_brute_force([(r.doc_id, r.text) for r in copies.collect()])


def test_links_of_the_table(docs):
    assert found(docs) == near_by_brute_force([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_links_of_odd_rows(odd, empty):
    assert found(odd) == near_by_brute_force([(r.doc_id, r.text) for r in odd.collect()])
    assert found(empty) == []


def trie_by_brute_force(paths):
    nodes, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            nodes[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    kids = collections.Counter(k[:-1] for k in nodes if k)
    saved, leaves = collections.Counter(), collections.Counter()
    for k, members in nodes.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(members) - 1) * len(k[-1][1]) if k else 0
            leaves[k[:d]] += not kids[k]
    digest = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k], digest(ends[k])) for k, m in nodes.items()), key=str)


def paths_of(rows, group=100, modulus=6):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()), role, text))
    own = {c: [(r, x) for _, r, x in sorted(v)] for c, v in own.items()}
    cut = {c: zlib.crc32(str(c).encode()) % modulus for c in own}
    return {c: own.get(c - c % group, [])[: cut[c]] + v[cut[c] :] for c, v in own.items()}


def test_trie_of_the_table(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in queries.op13_conversation_trie(spark, str(data)).collect()), key=str) == trie_by_brute_force(paths_of(rows))


def test_trie_of_odd_conversations(spark, monkeypatch):
    """Long conversations over several blocks, ends within and at the end of a block, turnless ones, nulls, ties and repeated rows, many ends in a node."""
    monkeypatch.setattr(conversation_trie, "CHUNK_BITS", 2)
    rows = [(c, t, "user" if t % 2 else "bot", f"turn {t}") for c, n in ((0, 40), (1, 40), (2, 41), (3, 8), (4, 16), (5, 17), (6, 24), (7, 1)) for t in range(n)]
    rows += [(c, t, "user", "same") for c in range(200, 260) for t in range(9)]
    rows += [(11, None, None, None), (11, 3, "user", None), (11, 3, "user", "tie"), (11, 3, "user", "tie"), (None, 1, "user", "nobody's"), (777, 0, "user", "its opening is missing"), (12, 0, "", "x" * 30_000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS block", "'x' AS id", "2 AS pos").repartition(4)

    def run(df):
        return sorted((tuple(r) for r in conversation_trie.prefix_trie(conversation_trie.rebuilt(conversation_trie.numbered(df))).collect()), key=str)

    assert run(table) == trie_by_brute_force(paths_of(rows))
    assert run(table.limit(0)) == []


def test_small_sets_lose_no_partner():
    """Whole sets went to every pair and block; now small ones go first, and a near pair always passes them, even where its tokens collide when they are cut."""
    import numpy as np

    rng = np.random.default_rng(7)
    for n in (1, 4, 5, 30, 200):
        for bits in (63, 12):
            high = rng.choice(2**20, 2 * n, False).astype(np.uint64) << np.uint64(40)
            tokens = np.unique(high | rng.integers(0, 2 ** min(bits, 30), 2 * n).astype(np.uint64))
            for lost in range(n):
                a, b = tokens[:n], np.sort(np.delete(tokens, rng.choice(n, lost, False)))[: n + lost]
                both = len(np.intersect1d(a, b))
                if 100 * both >= 80 * (len(a) + len(b) - both):
                    (x, need_x), (y, need_y) = jaccard_join.small_set(a, 80), jaccard_join.small_set(b, 80)
                    assert len(np.intersect1d(x, y)) >= min(need_x, need_y)


def test_sketches_lose_no_partner_and_are_small():
    """Sketches of sets, of one size or folded, differ in no more bits than the sets in tokens; unlike sets of a hundred tokens or more are told apart."""
    import numpy as np

    rng = np.random.default_rng(3)
    new = lambda n: rng.integers(0, 2**63, n, dtype=np.uint64)
    for n in (1, 2, 5, 63, 64, 65, 100, 128, 500, 513, 2000):
        for lost in (0, n // 20, n // 10, n // 5):
            base = new(n)
            a, b = np.unique(base), np.unique(np.concatenate([base[lost:], new(lost // 2)]))
            both = len(np.intersect1d(a, b))
            x, y = (jaccard_join.sketch(v).view(np.uint64) for v in (a, b))
            assert 8 * len(x) < 4 * n + 16 and max(len(x), len(y)) <= 2 * min(len(x), len(y))
            x, y = (v[: len(v) // 2] ^ v[len(v) // 2 :] if len(v) > min(len(x), len(y)) else v for v in (x, y))
            differ = int(np.bitwise_count(x ^ y).sum())
            assert differ <= len(a) + len(b) - 2 * both
            if 100 * both >= 80 * (len(a) + len(b) - both):
                assert differ <= jaccard_join.apart(len(a), len(b), 80)
        if n >= 100:
            assert int(np.bitwise_count((jaccard_join.sketch(new(n)) ^ jaccard_join.sketch(new(n))).view(np.uint64)).sum()) > jaccard_join.apart(n, n, 80)


def test_labels_are_joined_to_classes_not_to_tokens(copies, monkeypatch):
    """A row for each class went with each of its tokens through the join with labels and sets."""
    monkeypatch.setattr(jaccard_join, "SMALL", 2)
    kept, real = {}, jaccard_join.stash
    monkeypatch.setattr(jaccard_join, "stash", lambda df, name: kept.setdefault(name, real(df, name)))
    found(copies)
    labelled = kept["jaccard-labelled"]
    assert labelled.count() == labelled.select("cid").distinct().count() > 0
