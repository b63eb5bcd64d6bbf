"""Language, toxicity, quality: learned behaviour, odd rows, empty tables."""

import collections
import itertools
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from barflow.llm import codes, language, quality, toxicity
from barflow.llm.codes import BASE, Hasher, blocks, pieces, runs, word_characters
from barflow.llm.frames import importable

DOCS = "doc_id long, text string, lang string, source string, score double"


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")


def test_blocks_keep_every_character():
    texts = ["ab cd", None, "", "x" * 50, "é ü " * 20]
    parts = {}
    for block in blocks(texts, 16):
        ends = np.append(block.starts[1:] - 1, len(block.codes) - 1)
        for s, e, o in zip(block.starts, ends, block.owner):
            parts[o] = parts.get(o, "") + "".join(map(chr, block.codes[s:e]))
    assert [parts[i] for i in range(5)] == [t or "" for t in texts]
    assert list(pieces("aa bb cc", 4)) == ["aa ", "bb ", "cc"]
    assert list(pieces("aaaaaaa\tbb ccccccc", 4)) == ["aaaaaaa\t", "bb ", "ccccccc"]


def test_hashes_depend_on_characters_only():
    block = next(blocks(["one two one", "two"]))
    starts, ends = runs(word_characters()[block.codes])
    h = Hasher(block.codes).stretches(starts, ends)
    assert h[0] == h[2] != h[1] == h[3]


def test_language_on_held_out(tables):
    docs, _ = tables
    rows = language.identify_documents(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    tested = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in tested) >= 0.95 * len(tested)


def test_language_edges(spark, tables):
    model = language.fit_languages(tables[0])
    rows = [(1, None, "en", None, 1.0), (2, "", None, None, None), (3, "12 34 !?", "de", "s", 0.0), (4, "日本語", "en", "s", 0.0),
            (None, "the and of that", "en", "s", 0.0), (None, "the and of that", "en", "s", 0.0), (5, "the and of " * 200_000, "en", "s", 0.0)]
    out = language.identify(spark.createDataFrame(rows, DOCS), model).collect()
    assert [r.lang_pred for r in out[:3]] == ["und"] * 3 and [r.score for r in out[:3]] == [0.0] * 3
    assert out[3].lang_pred == "de" and abs(out[3].score - 1 / len(model.languages)) < 1e-6  # all tie: first by name
    assert {r.lang_pred for r in out[4:]} == {"en"}
    empty = spark.createDataFrame([], DOCS)
    assert language.identify_documents(empty).count() == 0
    untaught = language.fit_languages(empty)
    assert language.identify(spark.createDataFrame(rows, DOCS), untaught).first().lang_pred == "und"
    with pytest.raises(ValueError):
        language.identify(empty, model, keep=("doc_id", "score"))


def test_unseen_words_back_off():
    keys = [np.array([7], np.uint64)] + [np.zeros(0, np.uint64)] * 5
    block = next(blocks(["abcde xyz"]))
    starts, ends = language.word_runs(block)
    at = language.gram_starts(starts[:1], ends[:1], 2)[1]
    known = np.sort(language.spaced(block).stretches(at, at + 2))
    keys[2] = known
    costs = [np.zeros((1, 2), np.float32)] + [np.zeros((0, 2), np.float32)] * 5
    costs[2] = np.tile(np.array([[1.0, 3.0]], np.float32), (len(known), 1))
    model = language.LanguageModel(["a", "b"], keys, costs)
    row, table = language.word_costs(model, block, starts, ends)
    assert table[row[0]].tolist() == [1.0, 3.0] and table[row[1]][0] == table[row[1]][1]


M64 = (1 << 64) - 1


def plain_mix(h):
    h = (h ^ h >> 33) * 0xFF51AFD7ED558CCD & M64
    return h ^ h >> 29


def plain_hash(text):
    """The running-sum hash of one stretch, in whole numbers."""
    return plain_mix(sum((ord(c) + 1) * pow(int(BASE), i, 1 << 64) for i, c in enumerate(text)) & M64)


def plain_combine(*parts):
    h = parts[0]
    for p in parts[1:]:
        h = plain_mix((h * 0xD6E8FEB86659FD93 + p) & M64)
    return h


def plain_words(text, inside):
    """Maximal runs of characters that are ``inside``."""
    return ["".join(g) for k, g in itertools.groupby(text, inside) if k]


def plain_toxic(text):
    hashes = [plain_hash(w) for w in plain_words((text or "").lower(), str.isalnum)]
    found = set()
    for salt, offsets in enumerate(toxicity.PATTERNS):
        for i in range(len(hashes) - offsets[-1]):
            found.add(plain_combine(*(hashes[i + o] for o in offsets), salt + 1) >> 64 - toxicity.BITS)
    return found


def plain_quality(text):
    found, last = collections.Counter(), None
    for word in plain_words(text or "", lambda c: c > " "):
        found[plain_combine(plain_hash(word), 1) >> 64 - quality.BITS] += 1
        found[quality.REPEATED] += word == last
        last, edged = word, f" {word} "
        for n in quality.ORDERS:
            for i in range(len(edged) - n + 1):
                found[plain_combine(plain_hash(edged[i : i + n]), n) >> 64 - quality.BITS] += 1
    return +found


ODD = ["one two two", "two one", None, "", "  ", "a", "x\ty\r\nz z", "Äé 12_34 日本 語語", "two two\n\ntwo " * 9, "w" * 90 + " b b", "b"]


def some_texts(tables):
    return ODD + [r.text for r in tables[0].orderBy("doc_id").limit(200).select(F.substring("text", 1, 600).alias("text")).collect()]


@pytest.mark.parametrize("size", [8, 64, codes.BLOCK])
def test_features_against_plain_python(tables, monkeypatch, size):
    """Features do not depend on how texts are cut into blocks, nor on the texts beside them."""
    texts = some_texts(tables)[: 40 if size < codes.BLOCK else None]
    monkeypatch.setattr(codes.blocks, "__defaults__", (size,))
    assert [set(x.tolist()) for x in toxicity.distinct_features(texts)] == [plain_toxic(t) for t in texts]
    assert [dict(zip(b.tolist(), n.tolist())) for b, n in quality.counted(texts)] == [dict(plain_quality(t)) for t in texts]


def test_long_texts_keep_features_over_block_borders():
    text = "ab " * 87_386  # 262,158 characters
    assert set(toxicity.distinct_features([text])[0].tolist()) == plain_toxic("ab ab ab")
    (buckets, n), = quality.counted([text])
    assert n[buckets == quality.REPEATED] == 87_385


def test_ftrl_against_plain_python():
    """The same updates, one coordinate at a time."""
    texts = [f"plain number {i % 7} {'vile' if i % 3 == 0 else 'fine'} words" for i in range(60)]
    y, rows = np.array([i % 3 == 0 for i in range(60)], float), words(texts)
    model = toxicity.ftrl(rows, y, l1=1.0)
    z, n, order = collections.defaultdict(float), collections.defaultdict(float), np.random.default_rng(7)

    def weight(c, l1, l2=0.5, alpha=2.0, beta=1.0):
        over = max(0.0, abs(z[c]) - l1)
        return -math.copysign(over, z[c]) / ((beta + math.sqrt(n[c])) / alpha + l2)

    for _ in range(3):
        for i in order.permutation(len(rows)):
            used = [(c, weight(c, 1.0)) for c in rows[i].tolist()] + [("bias", weight("bias", 0.0))]
            g = 1 / (1 + math.exp(-sum(w for _, w in used))) - y[i]
            for c, w in used:
                z[c] += g - (math.sqrt(n[c] + g * g) - math.sqrt(n[c])) / 2.0 * w
                n[c] += g * g
    want = {c: weight(c, 1.0) for c in z if c != "bias" and abs(z[c]) > 1.0}
    assert dict(zip(model.index.tolist(), model.weight.tolist())) == pytest.approx(want, rel=1e-4)
    dense = model.dense()
    logit = [weight("bias", 0.0) + sum(want.get(c, 0.0) for c in plain_toxic(t)) for t in texts[:9]]
    assert toxicity.scores(model, texts[:9], dense) == pytest.approx([1 / (1 + math.exp(-v)) for v in logit], rel=1e-4)


def test_quality_scores_against_plain_python():
    texts = [f"{'good clean prose' if i % 2 else 'buy buy now'} {i}" for i in range(40)]
    model = quality.train(quality.counted(texts), np.arange(40) % 2, least_steps=400)
    logits = model.logits()
    got = quality.scores((logits[:, 1] - logits[:, 0]).astype(np.float32), float(model.bias[1] - model.bias[0]), texts)
    for text, score in zip(texts, got):
        n = plain_quality(text)
        hidden = sum(k * model.vectors[b].astype(float) for b, k in n.items()) / sum(n.values())
        out = np.exp(hidden @ model.output + model.bias)
        assert score == pytest.approx(out[1] / out.sum(), rel=1e-3)
    assert min(got[1::2]) > max(got[0::2])


def test_language_against_plain_python(tables):
    """Every word by its own frequency, else by the mean over its known n-grams of the longest order that has any."""
    model, texts = language.fit_languages(tables[0]), some_texts(tables)
    tables_by_key = [dict(zip(k.tolist(), c.tolist())) for k, c in zip(model.keys, model.costs)]
    k = len(model.languages)

    def cost(word):
        known = tables_by_key[0].get(plain_hash(word))
        for order in range(language.LONGEST, 0, -1):
            if known is not None:
                return known
            block = next(codes.blocks([word]))
            hasher, (starts, ends) = language.spaced(block), language.word_runs(block)
            at = language.gram_starts(starts, ends, order)[1]
            grams = [tables_by_key[order][h] for h in hasher.stretches(at, at + order).tolist() if h in tables_by_key[order]]
            known = [sum(g[j] for g in grams) / len(grams) for j in range(k)] if grams else None
        return known if known is not None else [math.log(2.0)] * k

    got = language.predict(model, texts)
    for text, lang, score in zip(texts, got["lang_pred"], got["score"]):
        found = plain_words(language._lowered([text])[0], str.isalpha)
        if not found:
            assert (lang, score) == ("und", 0.0)
            continue
        costs = [cost(w) for w in found]
        mean = [-sum(c[j] for c in costs) / len(costs) for j in range(k)]
        share = [math.exp(m - max(mean)) for m in mean]
        assert score == pytest.approx(max(share) / sum(share), rel=1e-3)
        if sorted(share)[-2] < 1 - 1e-4:
            assert lang == model.languages[share.index(max(share))]


def words(texts):
    return toxicity.distinct_features(texts)


def test_ftrl_is_sparse_and_separates():
    texts = [f"common text number {i} {'vile' if i % 4 == 0 else 'fine'} words" for i in range(400)]
    y = np.array([i % 4 == 0 for i in range(400)], float)
    model = toxicity.ftrl(words(texts), y)
    dense = model.dense()
    assert len(model.index) < len(set(np.concatenate(words(texts)))) / 5
    s = toxicity.scores(model, ["a vile thing", "a fine thing", "", None], dense)
    assert s[0] > s[1] and s[2] == s[3]


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality, "quality")])
def test_scores(spark, tables, module, label):
    docs, labels = tables
    out = module.score_documents(docs, labels).join(labels, "doc_id").collect()
    own = [r for r in out if not r.held_out]
    assert all(0 <= r.score <= 1 for r in out)
    high = [r.score for r in own if r[label] == 1]
    low = [r.score for r in own if r[label] == 0]
    assert np.mean(high) > np.mean(low) + 0.1
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = [(1, None, None, None, 0.5), (1, "", None, None, 0.5), (None, "x " * 400_000, "en", "s", None)]
    few = spark.createDataFrame(rows, DOCS)
    made = module.score_documents(few, empty).collect()
    assert len(made) == 3 and len({r.score for r in made}) == 1
    odd = spark.createDataFrame([(1, None, None), (1, 1, 1), (1, 0, 0), (None, 1, 1), (7, 5, 9)], "doc_id long, quality int, toxic int")
    assert module.score_documents(few, odd).count() == 3
    assert module.score_documents(spark.createDataFrame([], DOCS), labels).count() == 0


def test_quality_ignores_order_of_documents(tables):
    a = quality.counted(["one two two", "!!! ???"])
    b = quality.counted(["!!! ???", "one two two"])
    assert all((x[0] == y[0]).all() and (x[1] == y[1]).all() for x, y in zip(a, b[::-1]))
    assert quality.REPEATED in a[0][0] and quality.REPEATED not in a[1][0]
