"""Operators whose result is exact, against brute force."""

import collections
import hashlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from compare import rows, sql_rows
from pyspark.sql import functions as F

from newslode.llm import bpe, decontaminate, line_dedup, queries, simhash, token_count


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def keyed(df, *cols):
    return sorted(((r.doc_id, *(r[c] for c in cols)) for r in df.collect()), key=str)


# --- byte-level BPE ---


def bpe_expected(vocabulary, pairs):
    tiktoken = pytest.importorskip("tiktoken")
    enc = tiktoken.Encoding("own", pat_str=vocabulary.PATTERN, mergeable_ranks=bpe.load_ranks(vocabulary.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    out = []
    for i, t in pairs:
        ids = enc.encode_ordinary(t or "")
        out.append((i, len(ids), sha(",".join(map(str, ids))), sha(t or "")))
    return sorted(out, key=str)


@pytest.mark.parametrize("frequent", [0, 50])
def test_bpe_odd(spark, odd, vocabulary, frequent):
    path = vocabulary.path("byte_bpe_multi_50k.tiktoken")
    ids = bpe.encode(spark, odd, path, vocabulary.PATTERN, frequent=frequent)
    got = sorted(((r.doc_id, len(r.ids), sha(",".join(map(str, r.ids))), sha(bytes(r.decoded))) for r in bpe.decode(spark, ids, path).collect()), key=str)
    assert got == bpe_expected(vocabulary, texts(odd))


def test_bpe_query(spark, data, docs, vocabulary):
    got = keyed(queries.op1_byte_bpe(spark, data), "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == bpe_expected(vocabulary, texts(docs))


def test_bpe_empty(spark, empty, vocabulary):
    assert bpe.round_trip(spark, empty, vocabulary.path("byte_bpe_multi_50k.tiktoken"), vocabulary.PATTERN).count() == 0


def test_pair_table_holds_every_pair_and_no_other(vocabulary):
    ranks = bpe.load_ranks(vocabulary.path("byte_bpe_multi_50k.tiktoken"))
    slots, rows = bpe.pair_table(ranks)
    pieces = {r: p for p, r in ranks.items()}
    found = lambda a, b: int(slots[rows[a + 2] + b + 2]) ^ (a + 2) << bpe.PIECE
    assert all(found(ranks[p[:k]], ranks[p[k:]]) == r for p, r in ranks.items() for k in range(1, len(p)) if p[:k] in ranks and p[k:] in ranks)
    g = np.random.default_rng(0)
    for a, b in g.integers(0, len(pieces), (20_000, 2)).tolist():
        assert min(found(a, b), bpe.NO_PAIR) == ranks.get(pieces[a] + pieces[b], bpe.NO_PAIR)
    # At a word's edge there is no pair.
    assert (np.minimum(slots[rows[1] + np.arange(len(rows))] ^ 1 << bpe.PIECE, bpe.NO_PAIR) == bpe.NO_PAIR).all()
    assert (np.minimum(slots[rows + 1] ^ np.arange(len(rows)) << bpe.PIECE, bpe.NO_PAIR) == bpe.NO_PAIR)[1:].all()
    assert bpe.not_merged(ranks) == {}


def test_words_that_their_merges_do_not_reach(spark, tmp_path):
    """A vocabulary by hand: a word that is a piece has its own id even where its merges end elsewhere; ties go to the left."""
    import base64

    import tiktoken

    pieces = [bytes([i]) for i in range(256)] + [b"bc", b"ab", b"abc", b"aba", b"ba", b"xyz"]
    path = tmp_path / "own.tiktoken"
    path.write_text("".join(f"{base64.b64encode(p).decode()} {i}\n" for i, p in enumerate(pieces)))
    enc = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=bpe.load_ranks(str(path)), special_tokens={})
    words = ["abc", "xyz", "xyzz", "ababa", "aabababab", "bcbcabc", "cab", "a"]
    assert list(bpe.not_merged(bpe.load_ranks(str(path)))) == ["xyz"]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "doc_id long, text string")
    for frequent in (1, 100):
        got = {r.doc_id: r.ids for r in bpe.encode(spark, df, str(path), r"\S+|\s+", frequent=frequent).collect()}
        assert got == {i: enc.encode_ordinary(w) for i, w in enumerate(words)}


def test_long_words_by_heap(vocabulary):
    tiktoken = pytest.importorskip("tiktoken")
    ranks = bpe.load_ranks(vocabulary.path("byte_bpe_multi_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    for w in ("a", "abababab" * 40, "lorem" * 300, "é" * 50, "the", "zzzzzzz"):
        assert bpe.encode_long(w.encode(), ranks) == enc.encode_ordinary(w)


# --- token counts ---


def counts_expected(vocabulary, pairs, limit=512):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(vocabulary.path("byte_bpe_50k.json"))
    out = []
    for i, x in pairs:
        n = len(t.encode(x or "", add_special_tokens=False).ids)
        out.append((i, len((x or "").encode()), n, n > limit))
    return sorted(out, key=str)


def test_counts(spark, odd, docs, empty, data, vocabulary):
    path = vocabulary.path("byte_bpe_50k.json")
    special = spark.createDataFrame([(1, "a<|endoftext|>b <|endoftext|>"), (2, "<|endoftext|>")], "doc_id long, text string")
    for df in (odd, special):
        assert keyed(token_count.token_counts(spark, df, path, vocabulary.PATTERN), "n_bytes", "n_tokens", "over_limit") == counts_expected(vocabulary, texts(df))
    assert keyed(queries.op8_token_count(spark, data), "n_bytes", "n_tokens", "over_limit") == counts_expected(vocabulary, texts(docs))
    assert token_count.token_counts(spark, empty, path, vocabulary.PATTERN).count() == 0


# --- line dedup ---


def lines_expected(pairs, least=40, docs=5):
    holders = collections.defaultdict(set)
    for i, t in pairs:
        for line in (t or "").split("\n"):
            if i is not None and len(k := line_dedup.line_key(line)) >= least:
                holders[k].add(i)
    out = []
    for i, t in pairs:
        ls = (t or "").split("\n")
        kept = [x for x in ls if i is None or not (len(holders[k := line_dedup.line_key(x)]) >= docs and max(holders[k]) != i)]
        out.append((i, len(ls), len(ls) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=str)


def test_lines(spark, odd, empty, data):
    assert keyed(line_dedup.report(odd), "n_lines", "n_dropped", "kept_sha256") == lines_expected(texts(odd))
    assert line_dedup.report(empty).count() == 0 and line_dedup.dedup(empty).count() == 0
    clean = line_dedup.dedup(odd)
    assert clean.columns == odd.columns and clean.count() == odd.count()
    assert {r.text for r in clean.where("doc_id = 5").collect()} == {"The quick brown fox jumps over the lazy dog, again and again."}
    assert clean.where("doc_id = 1").first().text == "short"
    names, want = sql_rows(queries.ORACLE_SQL["op3_line_dedup"], data)
    assert rows(queries.op3_line_dedup(spark, data)) == want


def test_a_line_in_a_third_of_all_documents(spark):
    """One hot line over many partitions: only one document keeps it."""
    hot = "this very line stands in a third of all the documents there are"
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.concat(F.lit(hot + "\nown line number "), F.col("id").cast("string"))).otherwise(F.concat(F.lit("nothing but an own long line of words with number "), F.col("id").cast("string"))).alias("text")).repartition(7)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        got = {r.doc_id: r.n_dropped for r in line_dedup.report(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == {i: int(i % 3 == 0 and i != 2997) for i in range(3000)}


# --- SimHash ---


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(pairs):
    """(doc_id, fingerprint) of every row to the smallest id reachable."""
    fps = sorted({f for _, f in pairs})
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    least = {}
    for i, f in pairs:
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return sorted(((i, least.get(find(f))) for i, f in pairs), key=str)


def test_simhash(spark, odd, docs, empty, data):
    for df in (odd, docs):
        pairs = [(i, brute_fingerprint(t)) for i, t in texts(df)]
        got = simhash.near_duplicates(df).collect()
        assert sorted(((r.doc_id, r.fp & (2**64 - 1)) for r in got), key=str) == sorted(pairs, key=str)
        assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == brute_components(pairs)
    assert queries.op9_simhash(spark, data).where("fingerprint RLIKE '^[0-9a-f]{16}$'").count() == docs.count()
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_of_each(empty).count() == 0
    one = simhash.one_of_each(odd)
    assert one.columns == odd.columns and {r.doc_id for r in one.collect()} >= {1, 2, 6, None, 8, 9, 10}


def test_near_copies_go_by_id_and_text(spark):
    """An id with two texts loses the one that is a copy of another document, not the other."""
    copy, own = "one two three four five six seven", "red green blue black white brown grey pink"
    rows = [(1, copy), (5, copy), (5, own), (7, own), (1, copy), (None, copy)]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([(1, copy), (1, copy), (5, own), (None, copy)], key=str)


def test_unsettled_links_are_an_error(spark):
    chain = spark.createDataFrame([(i + 1, i) for i in range(40)], "a long, b long").repartition(20)
    assert {r.root for r in simhash.components(chain).collect()} == {0}
    with pytest.raises(RuntimeError):
        simhash.components(chain, most_rounds=1)


@pytest.mark.parametrize("split", [50_000, 3])
def test_links_lose_none(spark, monkeypatch, split):
    """Chains and clouds of near fingerprints; also when every anchor counts as hot."""
    monkeypatch.setattr(simhash, "SPLIT_ROWS", split)
    g = np.random.default_rng(3)
    base = g.integers(0, 2**63, 40, dtype=np.uint64)
    fps = set(base.tolist())
    for b in base[:10].tolist():  # chains whose ends are far apart
        for _ in range(12):
            b ^= (1 << int(g.integers(64))) ^ (1 << int(g.integers(64)))
            fps.add(b)
    for b in base[10:14].tolist():  # clouds around one point
        for _ in range(40):
            fps.add(b ^ (1 << int(g.integers(64))) ^ (1 << int(g.integers(64))) ^ (1 << int(g.integers(64))))
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    root = {r.node & (2**64 - 1): r.root for r in simhash.components(simhash.link_forest(df)).collect()}
    number = {f: i for i, f in enumerate(fps)}
    want = dict(brute_components([(number[f], f) for f in fps]))
    groups = collections.defaultdict(set)
    for f in fps:
        groups[root.get(f, int(np.uint64(f).view(np.int64)))].add(number[f])
    assert {min(g): g for g in groups.values()} == {k: {i for i, c in want.items() if c == k} for k in set(want.values())}


def test_codes_are_perfect():
    code = simhash.Anchors()
    g = np.random.default_rng(1)
    x = g.integers(0, 2**63, 2000, dtype=np.uint64)
    a = code.nearest(x).astype(np.uint64)
    for shift, bits, *_, radius in simhash.BLOCKS:
        d = np.bitwise_count((x ^ a) >> np.uint64(shift) & np.uint64((1 << bits) - 1))
        assert d.max() <= radius
    assert (code.nearest(a) == a.astype(np.int64)).all()


# --- decontamination ---


def contamination_expected(pairs, items, size=13):
    windows = collections.defaultdict(set)
    words = lambda t: decontaminate.WORD.findall((t or "").encode().lower())
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[k : k + size])].add(i)
    sizes = {len(w) for w in windows}
    out = []
    for i, t in pairs:
        w, its = words(t), set()
        hit = [False] * len(w)
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (own := tuple(w[k : k + n])) in windows:
                    its |= windows[own]
                    hit[k : k + n] = [True] * n
        n = sum(hit)
        out.append((i, len(w), n, len(its), sha(",".join(sorted(map(str, its)))), n > 0 and 20 * n >= len(w)))
    return sorted(out, key=str)


COLS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_decontamination(spark, odd, docs, empty, data):
    bench = spark.read.parquet(f"{data}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    found = queries.op10_decontamination(spark, data)
    assert keyed(found, *COLS) == contamination_expected(texts(docs), items)
    assert rows(found) == sql_rows(queries.ORACLE_SQL["op10_decontamination"], data)[1]
    short = [(900, "brown FOX"), (901, "over the"), (902, ""), (903, None), (904, "naïve"), (905, "word"), (906, "the quick brown fox jumps over the lazy dog again and again short the quick")]
    more = bench.unionByName(spark.createDataFrame(short, "item_id long, text string"))
    want = contamination_expected(texts(odd), items + short)
    assert keyed(decontaminate.report(odd, more), *COLS) == want
    assert keyed(decontaminate.report(odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), more, block_bytes=2000), *COLS) == sorted({x for x in want if x[0] is not None}, key=str)
    assert decontaminate.report(empty, more).count() == 0 and keyed(decontaminate.report(odd, bench.limit(0)), "n_hit") == sorted(((i, 0) for i, _ in texts(odd)), key=str)
    for block in (4_000_000, 2000):
        kept = decontaminate.clean(odd, more, block_bytes=block)
        bad = {x[0] for x in want if x[-1] and x[0] is not None}
        assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} - {None} == {i for i, _ in texts(odd) if i is not None} - bad


def test_decontamination_without_ids(spark):
    """Rows and items without an id, in one block and in several."""
    passage = "alpha beta gamma delta epsilon"
    docs = spark.createDataFrame([(None, f"{passage} one"), (None, "a clean row of other words"), (1, f"{passage} two"), (2, "zeta eta theta"), (3, "another clean row")], "doc_id long, text string")
    items = spark.createDataFrame([(None, passage), (None, "beta gamma"), (7, passage), (None, "zeta eta theta"), (8, "nowhere " * 40)], "item_id long, text string")
    con = duckdb.connect()
    for name, df in (("documents", docs.where("doc_id IS NOT NULL")), ("benchmark", items)):
        con.register(name, pa.Table.from_pylist([r.asDict() for r in df.collect()]))
    sql = con.execute(queries.ORACLE_SQL["op10_decontamination"])
    place = [[d[0] for d in sql.description].index(c) for c in ("doc_id", *COLS)]
    want = sorted(tuple(r[i] for i in place) for r in sql.fetchall())
    for block in (4_000_000, 40):
        found = keyed(decontaminate.report(docs, items, block_bytes=block), *COLS)
        assert sorted(x for x in found if x[0] is not None) == want
        assert sorted(x[1:] for x in found if x[0] is None) == [(6, 0, 0, sha(""), False), (6, 5, 2, sha("7"), True)]
        assert sorted(r.text for r in decontaminate.clean(docs, items, block_bytes=block).collect()) == ["a clean row of other words", "another clean row"]


def test_fm_index():
    g = np.random.default_rng(2)
    for n, v in ((0, 3), (1, 3), (50, 2), (400, 5)):
        seq = g.integers(1, v + 1, n).astype(np.int32)
        seq[::17] = 0
        index = decontaminate.FMIndex(seq, v)
        for size in (1, 2, 5):
            words = g.integers(1, v + 1, (20, size)).astype(np.int32)
            low, high = index.search(words)
            for w, a, b in zip(words, low, high):
                want = [i for i in range(n - size + 1) if (seq[i : i + size] == w).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == want


# --- pipeline ---


def test_pipeline_rows(spark, data, docs, labels, vocabulary):
    """Every stage's rows against brute force over what the stage before kept; the toxic ones as the model scores them."""
    import corpus_pipeline

    from newslode.llm import toxicity
    from newslode.llm.common import stash

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "decontamination", "byte_bpe"]
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(stash(stage(spark, kept[-1], data), f"test-{name}"))
    before, clean, lines, single, own = (texts(x) for x in kept[:5])
    toxic = {r.doc_id for r in toxicity.score(docs, labels).where("predicted = 1").collect()}
    assert sorted(clean, key=str) == sorted(((i, t) for i, t in before if i not in toxic), key=str)
    assert sorted((i, sha(t or "")) for i, t in lines) == sorted((i, s) for i, _, _, s in lines_expected(clean))
    named = brute_components([(i, brute_fingerprint(t)) for i, t in lines])
    assert sorted(i for i, _ in single) == sorted(i for i, c in named if i == c) and set(single) <= set(lines)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    hit = {r[0] for r in contamination_expected(single, items) if r[-1]}
    assert sorted(own, key=str) == sorted(((i, t) for i, t in single if i not in hit), key=str)
    got = sorted(((r.doc_id, r.n_tokens, sha(",".join(map(str, r.ids))), r.decoded_sha256) for r in kept[5].collect()), key=str)
    assert got == bpe_expected(vocabulary, own)
