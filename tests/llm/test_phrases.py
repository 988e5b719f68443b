"""Phrase mining against brute force."""

import collections
import random
import re
import string

import pytest

from newslode.llm import phrases

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def by_brute_force(rows, threshold, most, percent=100):
    counts, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    counts[lang, tuple(w[i : i + k])] += 1
    f = {p: c for p, c in counts.items() if c >= threshold}
    out = collections.defaultdict(list)
    longer = collections.defaultdict(int)
    for (lang, p), c in f.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                longer[lang, p[i : i + k]] = max(longer[lang, p[i : i + k]], c)
    for (lang, p), a in f.items():
        if len(p) > 1 and not 100 * longer[lang, p] >= percent * a:
            cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, r + 1, p.decode(), -a, l, right, n[lang], -s) for lang, found in out.items() for r, (s, a, p, l, right) in enumerate(sorted(found)[:most]))


@pytest.fixture(scope="module")
def told(spark):
    """Sentences with sure phrases, some of them only inside longer ones, in several languages; nulls, NULs, repeats and odd blanks."""
    rng = random.Random(8)
    sure = ["New York Stock Exchange", "copper cathode", "in spite of the", "é ü", "x\x00y z"]
    rows = []
    for i in range(300):
        words = [rng.choice(sure) if rng.random() < 0.3 else rng.choice("a b c d the of in copper York".split()) for _ in range(rng.randint(0, 25))]
        rows.append((rng.choice(("en", "de", None)), rng.choice((" ", "  ", "\t")).join(words).replace(" d ", rng.choice((". ", "\n", " d ", "; ")))))
    rows += [("en", None), ("en", ""), (None, " \t "), ("fr", "too rare to count"), *rows[:9]]
    return spark.createDataFrame([(*r, i, "x") for i, r in enumerate(rows)], "lang string, text string, n int, words string").repartition(5), rows


@pytest.mark.parametrize("shards, bits, threshold, percent", [(2, phrases.BITS, 12, 100), (3, 2**10, 7, 60)])
def test_phrases_by_brute_force(told, shards, bits, threshold, percent):
    """With filters that hardly ever err and with ones that nearly always do."""
    df, rows = told
    got = phrases.collocations(df, threshold, 15, percent, shards, bits)
    assert sorted(tuple(r) for r in got.collect()) == by_brute_force(rows, threshold, 15, percent)


def test_phrases_of_few_or_no_rows(told, odd, empty):
    df, _ = told
    for rows in (empty, odd.where("doc_id = 7"), df.limit(3)):
        assert phrases.collocations(rows, 100, 10).count() == 0
    assert phrases.collocations(odd, 100, 10).count() == len(by_brute_force([(r.lang, r.text) for r in odd.collect()], 100, 10)) > 0


def test_query_gives_the_rows_of_its_sql(spark, data):
    from compare import rows, sql_rows

    from newslode.llm import queries

    for name in ("op11_phrases", "op13_conversation_trie"):
        df = queries.QUERIES[name](spark, data)
        names, want = sql_rows(queries.ORACLE_SQL[name], data)
        assert sorted(df.columns) == names
        assert rows(df) == want


def test_counts_of_scans_before_the_last_cycle_are_deleted(spark, docs, monkeypatch):
    """All scans' tables of counts lay on the disk until the end, though a cycle of them is all that is read."""
    import os
    import urllib.parse

    there, most, real = set(), [], phrases.stash

    def kept(df, name, *more):
        out = real(df, name, *more)
        if name == "phrase-counts":
            there.add(urllib.parse.urlparse(out.inputFiles()[0]).path.rpartition("/")[0])
            most.append(sum(map(os.path.isdir, there)))
        return out

    monkeypatch.setattr(phrases, "stash", kept)
    assert phrases.collocations(docs, threshold=20, most=50).count() > 0
    assert len(most) > phrases.SHARDS + 1 and max(most) <= phrases.SHARDS + 1
    assert not any(map(os.path.isdir, there))


def test_last_scans_write_only_what_can_matter(told, spark, monkeypatch):
    """All counts of a phrase's last scan were written, most of them of phrases that had the share in no scan."""
    df, _ = told
    seen, stash = [], phrases.stash
    monkeypatch.setattr(phrases, "stash", lambda df, name, *a: (made := stash(df, name, *a), name == "phrase-counts" and seen.append({r[:2]: r[2] for r in made.collect()}))[0])
    found = phrases.frequent(phrases.stash(phrases.tokens(df, 2, 0), "phrase-tokens"), 150, 2)
    assert found.count() and len(seen) > 2
    words = [{k: n for k, n in x.items() if k[1] & 7 == 1} for x in seen[:2]]
    assert min(words[0].values()) < 75
    assert all(n >= 75 or words[0].get(k, 0) >= 75 for k, n in words[1].items())
    assert all(n > 0 for x in seen for n in x.values())


def test_rows_of_tokens_are_written_and_read_a_few_at_a_time(spark, monkeypatch):
    """A page of the table of tokens had 100 of its large rows, and a task read all its rows at once."""
    seen, stash, jvm = {}, phrases.stash, spark._jvm

    def pages(path):
        conf = spark._jsc.hadoopConfiguration()
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(path), conf))
        try:
            return [reader.readOffsetIndex(c).getPageCount() for g in reader.getFooter().getBlocks() for c in g.getColumns() if c.getPath().toDotString() == "words"]
        finally:
            reader.close()

    def kept(df, name, *more):
        seen[name, "read"] = int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize"))
        out = stash(df, name, *more)
        if name == "phrase-tokens":
            seen["rows"], seen["pages"] = out.count(), sum(n for f in out.inputFiles() for n in pages(f))
        return out

    monkeypatch.setattr(phrases, "stash", kept)
    docs = spark.range(0, 24, 1, 1).selectExpr("'en' as lang", "concat(repeat('ab cd ', 20), array_join(transform(sequence(1, 60000), i -> hex(xxhash64(id, i))), ' ')) as text")
    before = spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")
    assert phrases.collocations(docs, 100, 10).count() > 0
    assert seen["rows"] >= 24 and seen["pages"] >= 8  # of 1 MB; a row has half of that
    assert seen["phrase-counts", "read"] <= 16 and seen["phrases-identified", "read"] <= 16
    assert spark.conf.get("spark.sql.parquet.columnarReaderBatchSize") == before


def test_filters_keep_their_packed_slices_no_longer_than_needed(spark):
    """A worker held the filters twice, packed and unpacked."""
    import pickle

    import numpy as np

    made = phrases.filters(spark.range(1000).selectExpr("id as k1", "id % 2 = 0 as new"), phrases.BITS)
    there = pickle.loads(pickle.dumps(made))
    assert there.has(0, np.arange(1000, dtype=np.uint64)).all() and there.has(1, np.arange(0, 1000, 2, dtype=np.uint64)).all()
    assert made.slices and not there.slices
