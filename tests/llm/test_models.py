"""Operators that learn, sample or identify: held-out accuracy, defined results for odd rows, brute-force likeness."""

import collections
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from newslode.llm import language, license_scan, quality_crf, queries, toxicity, weighted_sampling


def test_language(spark, odd, docs, empty, data):
    got = {r.doc_id: r for r in queries.op7_language(spark, data).collect()}
    lang = {r.doc_id: r.lang for r in docs.collect()}
    held = [i for i, r in got.items() if r.held_out]
    assert len(got) == docs.count() and np.mean([got[i].lang_pred == lang[i] for i in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())
    mixed = docs.unionByName(odd.select(F.col("doc_id") + 10**6, "text", "lang", "source", "n_chars").toDF(*docs.columns))
    out = {r.doc_id: r.lang_pred for r in language.identify(mixed).collect() if r.doc_id and r.doc_id > 10**6}
    assert out[10**6 + 6] == out[10**6 + 7] == out[10**6 + 11] == "und"
    assert language.identify(empty).count() == 0
    assert {r.lang_pred for r in language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def scores(df, labels, label):
    m = df.join(labels, "doc_id").select("held_out", "predicted", F.col(label).alias("y")).collect()
    return m, [(r.predicted, r.y) for r in m if r.held_out]


def test_quality(spark, odd, empty, docs, labels, data):
    df = queries.op6_quality(spark, data)
    rows, held = scores(df, labels, "quality")
    assert df.count() == docs.count() and np.mean([p == y for p, y in held]) > 0.9
    out = quality_crf.score(odd, labels)
    assert out.count() == odd.count() and out.where("score < 0 OR score > 1").count() == 0
    one = quality_crf.score(odd, labels.where("quality = 1"))
    assert one.count() == odd.count() and quality_crf.score(empty, labels.limit(0)).count() == 0


def test_forward_backward_is_the_sum_over_paths():
    g = np.random.default_rng(0)
    unary, ties = g.standard_normal((2, 4)), g.standard_normal((2, 2))
    mask = np.array([[1, 1, 1, 1], [1, 1, 0, 0]], bool)
    p, pairs, log_z = quality_crf.forward_backward(unary, mask, ties)
    total, seen = 0.0, np.zeros((2, 2))
    for d in range(2):
        n = int(mask[d].sum())
        weight, marginal = 0.0, np.zeros(n)
        pair = np.zeros((2, 2))
        for path in np.ndindex(*[2] * n):
            w = np.exp(sum((unary[d, i] / 2) * (1 if s else -1) for i, s in enumerate(path)) + sum(ties[a, b] for a, b in zip(path, path[1:])))
            weight += w
            marginal += w * np.array(path)
            for a, b in zip(path, path[1:]):
                pair[a, b] += w
        assert np.allclose(p[d, :n], marginal / weight)
        total, seen = total + np.log(weight), seen + pair / weight
    assert np.isclose(total, log_z) and np.allclose(pairs, seen)


INSULTS = ("idiot", "moron", "scum", "stupid", "trash")


def test_toxicity_learns_and_generalises():
    g = np.random.default_rng(4)
    words = ["".join(g.choice(["th", "er", "on", "an", "re", "he", "in"], 3)) for _ in range(300)]
    rows = []
    for i in range(600):
        t = list(g.choice(words, int(g.integers(5, 90))))
        if i % 3 == 0:
            t.insert(int(g.integers(len(t))), str(g.choice(INSULTS)))
        rows.append((" ".join(t), int(i % 3 == 0)))
    net = toxicity.train(rows, rounds=10)
    test = [(" ".join([*g.choice(words, 40), *w, *g.choice(words, 40)]), y) for w, y in (((["idiot"]), 1), ((["scum"]), 1), ([], 0), ([], 0), (["stupidity"], 1))]
    w, per_doc = toxicity.tokens(pa.array([t for t, _ in test]))
    first, size, doc = toxicity.windows(per_doc)
    logit = net.logits(w, first, size)
    got = (logit[toxicity.highest(logit, doc)] > 0).astype(int).tolist()
    assert got[:4] == [1, 1, 0, 0]


def test_toxicity_gradients():
    net = toxicity.Network()
    for k in toxicity.Network.NAMES:
        setattr(net, k, getattr(net, k).astype(np.float64))
    w, per_doc = toxicity.tokens(pa.array(["a quick brown fox " * 12, "", "one two", "idiot fox"]))
    first, size, doc = toxicity.windows(per_doc)
    y, weight = np.array([1.0, 0, 1, 0, 1])[doc % 5], np.ones(len(first))

    def loss():
        z = net.logits(w, first, size).astype(float)
        return float(np.sum(np.logaddexp(0, z) - y * z))

    for k, grad in net.gradients(w, first, size, y, weight).items():
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        x = getattr(net, k)
        old = x[at]
        x[at] = old + 1e-3
        up = loss()
        x[at] = old - 1e-3
        down = loss()
        x[at] = old
        assert np.isclose(grad[at], (up - down) / 2e-3, rtol=2e-2, atol=1e-3), k


def test_windows_cover_and_overlap():
    first, size, doc = toxicity.windows(np.array([0, 5, 32, 33, 100]))
    assert doc.tolist() == [0, 1, 2, 3, 3, 4, 4, 4, 4, 4, 4] and size[0] == 0 and (first[-1] + size[-1]) == 170


def test_toxicity_rows(spark, odd, empty, docs, labels, data):
    df = queries.op2_toxicity(spark, data)
    assert df.count() == docs.count() and df.where("score < 0 OR score > 1").count() == 0
    assert df.where(F.col("held_out") != (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)).count() == 0
    assert toxicity.score(odd, labels).count() == odd.count()
    assert toxicity.score(empty, labels).count() == 0 and toxicity.clean(empty, labels).count() == 0
    kept = toxicity.clean(odd, labels)
    assert kept.columns == odd.columns


def test_licences(spark, odd, empty, docs, data):
    marks = {"cc-by-nc": "Licensed under CC BY-NC", "gpl": "licensed under the GNU General Public", "apache": "Apache License", "mit": "MIT License", "reserved": "All rights reserved"}
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in queries.op4_license_scan(spark, data).collect():
        assert set(filter(None, r.families.split(","))) == {k for k, v in marks.items() if v in text[r.doc_id]}
    assert {r.family for r in license_scan.scan(odd).collect()} == {"none"} and license_scan.scan(empty).count() == 0
    other = spark.createDataFrame([(1, "Released under the BSD 3-Clause License."), (2, "The driver has to show a license to the officer."), (3, "/* Copyright 1999 Foo. All rights reserved. */")], "doc_id long, text string")
    assert [r.family for r in license_scan.scan(docs.select("doc_id", "text").where("doc_id < 0").unionByName(other)).orderBy("doc_id").collect()] == ["bsd", "none", "reserved"]


def test_licence_wordings(spark, docs):
    """Wordings that no template holds word for word, licences of no listed family, and words that only look like them."""
    want = [
        ("MIT License", "mit"), ("Available under the MIT licence terms", "mit"), ("# SPDX-License-Identifier: MIT", "mit"), ("// SPDX-License-Identifier: Apache-2.0", "apache"), ("This project uses the Apache 2 license", "apache"),
        ("GNU GENERAL PUBLIC LICENSE", "gpl"), ("Licensed under the GPLv3", "gpl"), ("Licensed under GPL version 2", "gpl"), ("Licensed under the Foobar Public License 1.3.", "unknown"), ("This library is licensed under the Sleepycat License.", "unknown"),
        ("the GNU Affero General Public License as published by the Free Software Foundation, either version 3", "agpl"), ("GNU Lesser General Public License for more details, as published by the Free Software Foundation", "lgpl"),
        ("Licensed under CC BY-ND 4.0.", "cc-by-nd"), ("Licensed under the Eclipse Public License 2.0.", "epl"), ("Released under the GPL.", "gpl"), ("SPDX-License-Identifier: Apache-2.0", "apache"), ("ISC License", "isc"), ("The Unlicense", "unlicense"),
        ("Licensed under the Mulan PSL v2.", "unknown"), ("SPDX-License-Identifier: OFL-1.1", "unknown"),
        ("Keit mit das enge und mit der aubezu.", "none"), ("MIT is a university.", "none"),
    ]
    rows = spark.createDataFrame([(-1 - i, t) for i, (t, _) in enumerate(want)], "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan(docs.select("doc_id", "text").unionByName(rows)).where("doc_id < 0").collect()}
    assert [(t, got[-1 - i].family) for i, (t, _) in enumerate(want)] == want
    assert got[-1].confirmed and got[-7].confirmed and not got[-8].confirmed and not got[-9].confirmed
    # Families that share most words are told apart by the best template of all.
    assert all(got[-1 - i].confirmed for i, (_, family) in enumerate(want) if family in ("cc-by-nd", "epl", "isc", "unlicense"))


def test_licence_levels_come_from_data():
    """The level of a licence lies above the plain paragraphs held out; that of a family makes unlisted licences unknown."""
    plain = [f"the {a} {b} went to the {c}" for a in ("old", "small", "red") for b in ("dog", "general", "public", "file") for c in ("house", "license office", "store", "library")]
    c = license_scan.Classifier(plain)
    probabilities = lambda texts: np.array([c.one(license_scan.words_of(t)) for t in texts])
    assert 0 < c.level < 1 and (1 - probabilities(plain)[:, -1] < c.level).mean() > 0.95
    kind, _ = c.judge(probabilities(license_scan.UNLISTED[1::2]))
    assert np.mean([c.classes[k] in ("unknown", "none") for k in kind]) > 0.7
    strict = probabilities(["Licensed under the MIT license."])
    assert c.classes[c.judge(strict)[0][0]] == "mit"
    c.sure, c.level = 1.1, 0.0
    assert c.classes[c.judge(strict)[0][0]] == "unknown"
    c.level = 1.1
    assert c.classes[c.judge(strict)[0][0]] == "none"


def jaccard(a, b):
    bag = lambda t: collections.Counter(w for w in re.split(r"[ \t\n\x0b\f\r]+", t.lower()) if w)
    x, y = bag(a), bag(b)
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def test_fingerprints(spark, odd, empty, docs, data):
    got = {r.doc_id: r for r in queries.op5_fingerprints(spark, data).collect()}
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    ids, errors, signed, same = sorted(text), [], [], {}
    for i, d in enumerate(ids):
        a, b, r = text[d], text[ids[(i + 1) % len(ids)]], got[d]
        half = len(a) // 2
        edited = a[: len(a) - half] + b[:half]
        assert (r.n_chars, r.edited_sha256) == (len(a), hashlib.sha256(edited.encode()).hexdigest())
        for near, want in ((r.near_edited, jaccard(a, edited)), (r.near_next, jaccard(a, b))):
            errors.append(abs(near - want))
            signed.append(near - want)
        assert same.setdefault(a, r.fingerprint) == r.fingerprint
    assert np.mean(errors) < 0.05 and abs(np.mean(signed)) < 0.02
    out = weighted_sampling.fingerprints(odd).collect()
    assert len(out) == odd.count() and len({r.fingerprint for r in out if r.doc_id in (6, 7, 11)}) == 1
    assert weighted_sampling.fingerprints(empty).count() == 0
    alone = weighted_sampling.fingerprints(odd.where("doc_id = 9")).first()
    assert alone.near_next == 1.0


def test_pipeline_stages(spark, data, docs):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] and len(corpus_pipeline.STAGES) == 5
    now, seen = docs, []
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, data)
        seen.append((now.columns, now.count()))
    assert all(c == docs.columns for c, _ in seen[:-1]) and seen[-1][1] == seen[-2][1] > 0
    direct = corpus_pipeline.run(spark, data)
    assert direct.count() == seen[-1][1]
    assert direct.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
