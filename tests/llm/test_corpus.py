"""WARC, packing, SimHash and the pipeline: round trips, brute force, odd rows."""

import hashlib
import zlib

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from barflow.llm import graphs, packing, simhash, warc
from barflow.llm.frames import importable
from barflow.llm.queries import tokenizer_path
from barflow.llm.tokens import TokenIds
from barflow.session import new_path

DOCS = "doc_id long, text string, fp int, component_id string"


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    importable(spark)


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], DOCS)


# --- WARC

PAGES = "page_id long, url string, html string, record_type string, digest int"


def test_archives_round_trip(spark):
    big = "é\r\n" * 30_000 + "\r\r\n\r"
    rows = [(1, "u", big), (2, "u x\n", big), (3, None, None), (4, "v", ""), (5, "v", "short\r\n"), (6, "v", "short\r\n"),
            (None, "w", "x" * 200), (7, "w", "x" * 200), (8, "w", "x" * 200), (8, "w", "x" * 200),
            (9, "w", "\r\n\r\nWARC/1.1\r\n" * 20 + "\r"), (10, "w", "y" * 99), (11, "w", "y" * 99), (12, "w", "z" * 100), (13, "w", "z" * 100)]
    pages = spark.createDataFrame([(*r, "a", 1) for r in rows], PAGES)
    out = sorted(map(tuple, warc.archive_pages(pages).collect()), key=repr)
    first = {}
    for i, _, html in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        first.setdefault(html or "", i)
    want = []
    for i, _, html in rows:
        raw = (html or "").encode()
        again = i is not None and len(raw) >= 100 and i > first[html or ""]
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[html] if again else None))
    assert out == sorted(want, key=repr)
    path = new_path(spark, "warc")
    cut = warc.chunk_table(pages, chunk=1001)  # also within a character and between a carriage return and its line feed
    assert cut.selectExpr("max(length(data))").first()[0] == 1001
    warc.write_archives(cut, path)
    chunks = warc.read_chunks(spark, path).where("record_id = '<urn:page:1>'").orderBy("chunk").collect()
    digest = hashlib.sha256()
    for k, c in enumerate(chunks):
        digest.update(c.data)
        assert c.chunk == k and c.running_digest == digest.hexdigest() and c.last == (k == len(chunks) - 1)
    assert len(chunks) > 80 and b"".join(c.data for c in chunks) == big.encode()
    assert warc.archive_pages(pages.where("false")).count() == 0


def test_damaged_archive_is_refused():
    reader = warc._Reader(True)
    for line in [b"WARC/1.1", b"WARC-Type: response", b"WARC-Record-ID: <urn:page:1>",
                 b"WARC-Payload-Digest: sha256:00", b"Content-Length: 4", b""]:
        reader.line(line)
    with pytest.raises(ValueError):
        reader.line(b"abcd")


# --- packing

def test_neighbours_against_plain_bm25():
    rng = np.random.default_rng(3)
    texts = [np.concatenate([rng.integers(0, 12, rng.integers(0, 30)), rng.integers(12, 400, rng.integers(0, 20))]) for _ in range(120)]
    shard, sizes = packing.Bm25Shard(texts), np.array([len(d) for d in texts])
    assert len(shard.dense) and (shard.place < 0).any()
    for seed, own in enumerate(texts):
        want = np.zeros(len(texts))
        for term in set(own.tolist()):
            tf = np.array([(d == term).sum() for d in texts])
            df = (tf > 0).sum()
            norm = packing.K1 * (1 - packing.B + packing.B * sizes / sizes.mean())
            want += np.log(1 + (len(texts) - df + 0.5) / (df + 0.5)) * tf * (packing.K1 + 1) / (tf + norm)
        assert np.allclose(shard.scores(seed), want, atol=1e-4)
    assert max(map(len, packing.Bm25Shard(texts, 5).queries)) == 5


def test_other_tokenizer_files_are_used_whole():
    import public_tokenizers

    ids = TokenIds(public_tokenizers.path("byte_bpe_50k.json"))
    text = "Plain Words, 123\tand  more don't"
    assert not ids.by_word and TokenIds(tokenizer_path()).by_word
    assert ids.encode(text).tolist() == ids.tokenizer.encode(text, add_special_tokens=False).ids


def check_packing(pieces, texts):
    """texts: id to text. Every id once, digests right, sequences gapless and at most a window long."""
    tokenizer, by_doc, by_sequence = TokenIds(tokenizer_path()).tokenizer, {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(texts)
    for i, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.length > 0
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    padding = 0
    for found in by_sequence.values():
        at = 0
        for p in sorted(found, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= packing.WINDOW
        padding += 0 if at & (at - 1) == 0 else packing.WINDOW - at
    return padding


def test_packing_is_exact(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in table.select("doc_id", "text").collect()}
    for size in (1 << 15, 1 << 20):
        assert check_packing(packing.pack(table, tokenizer_path(), shard_tokens=size).collect(), texts) == 0


def test_odd_texts(spark):
    odd = ["", "  ", None, "İstanbul ſ K Σίσυφος", "<|endoftext|> x", "é é ﬁ", "don't I'LL '", "²½x3", "\x1fa\x85b\xa0c",
           "日本語 テキスト", "a" * 9000, "µßÀÉŒœ Ŀ", "x'sx", "`'sd'", "naïve café 123 456,789", "word " * 30_000]
    rows = list(enumerate(odd))
    assert check_packing(packing.pack(docs(spark, rows), tokenizer_path()).collect(), dict(rows)) == 0
    assert packing.pack(docs(spark, []), tokenizer_path()).count() == 0
    assert packing.pack(docs(spark, [(None, "a"), (None, "a")]), tokenizer_path()).count() == 2


def test_bm25_against_loops():
    draw = np.random.default_rng(2)
    bodies = [draw.integers(0, 30, n) for n in (5, 40, 1, 60, 20, 0)]
    shard = packing.Bm25Shard(bodies)
    mean = np.mean([len(b) for b in bodies])

    def weight(t, d):
        df = sum(t in b for b in bodies)
        tf = (bodies[d] == t).sum()
        norm = packing.K1 * (1 - packing.B + packing.B * len(bodies[d]) / mean)
        return np.log(1 + (len(bodies) - df + 0.5) / (df + 0.5)) * tf * (packing.K1 + 1) / (tf + norm)

    for seed in range(5):
        query = sorted(set(bodies[seed].tolist()), key=lambda t: -weight(t, seed))[: packing.QUERY_TERMS]
        assert np.allclose(shard.scores(seed), [sum(weight(t, d) for t in query) for d in range(len(bodies))], rtol=1e-4)


def test_neighbours_fill_a_window():
    """Of two topics, a window takes the documents of its seed's topic."""
    a, b = np.arange(100, 140), np.arange(500, 540)
    draw = np.random.default_rng(0)
    packer = packing.Packer(0, window=256)
    packer.add([(i, draw.permutation(np.tile((a, b)[i % 2], 2))[:64].astype("<u4")) for i in range(16)])
    packer.finish()
    topics = {}
    for key, *_, sequence, _ in packer.rows:
        topics.setdefault(sequence, set()).add(key % 2)
    assert all(len(t) == 1 for t in topics.values()) and len(topics) == 4


def test_short_neighbours_come_before_unrelated_documents():
    """A window takes all documents with a score, however many, before any without."""
    packer = packing.Packer(0, window=400)
    near = [(i, np.full(60 if i == 0 else 3, 7, "<u4")) for i in range(111)]
    packer.add(near + [(1000 + i, np.full(40, 100 + i, "<u4")) for i in range(20)])
    packer.finish()
    first = [key for key, *_, sequence, _ in packer.rows if sequence == 0]
    assert sorted(k for k in first if k < 1000) == list(range(111)) and len(first) == 112


# --- SimHash

def brute_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows, bits=3):
    prints = [brute_print(t) for _, t in rows]
    a, b = np.triu_indices(len(rows), 1)
    close = [(x ^ y).bit_count() <= bits for x, y in zip(np.array(prints, object)[a], np.array(prints, object)[b])]
    label = graphs.local_labels(len(rows), a[close], b[close])
    return prints, [min((rows[j][0] for j in np.flatnonzero(label == label[i]) if rows[j][0] is not None), default=None) for i in range(len(rows))]


def family(n=60):
    """Texts that differ in single words, exact copies and unrelated ones."""
    base = [f"w{i}" for i in range(400)]
    rows = [(500 - k, " ".join(f"changed{k}" if i == k else w for i, w in enumerate(base))) for k in range(n)]
    rows += [(k, f"other {k} text {k * k} here") for k in range(20)] + [(700, rows[0][1]), (701, rows[0][1].upper())]
    return rows + [(800, None), (801, ""), (799, " \t\n"), (900, "one two"), (901, "One  TWO"), (None, "one two"), (None, "lonely words")]


@pytest.mark.parametrize("cell", [4, 4096])
def test_groups_against_brute_force(spark, cell, monkeypatch):
    monkeypatch.setattr(simhash.links, "__defaults__", (3, cell))
    rows = family()
    prints, groups = brute_groups(rows)
    out = simhash.near_duplicates(docs(spark, rows)).collect()
    want = sorted(((i, f"{p:016x}", g) for (i, _), p, g in zip(rows, prints, groups)), key=repr)
    assert sorted(map(tuple, out), key=repr) == want
    assert len(set(groups)) < len(rows) - 30
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


@pytest.mark.parametrize("bits", [0, 1, 3, 5])
def test_anchors_cover(bits):
    draw = np.random.default_rng(4)
    for width in simhash.band_widths(bits):
        x = draw.integers(0, 1 << 63, 300).astype(np.uint64) & np.uint64((1 << width) - 1)
        flips = np.uint64(1) << draw.integers(0, width, 300).astype(np.uint64)
        for y in (x, x ^ flips):
            homes = {(r, a) for r, a, h in zip(*simhash.anchors(x, width)) if h}
            seen = {(r, a) for r, a, _ in zip(*simhash.anchors(y, width))}
            assert homes <= seen and len(homes) == 300


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 102), (101, 102), (5, 5)]
    out = dict(map(tuple, graphs.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert out == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}
    assert graphs.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_per_group(spark):
    rows = family(10)
    _, groups = brute_groups(rows)
    kept = simhash.one_per_group(docs(spark, rows + [(900, "one two"), (0, rows[10][1])])).collect()
    named = [r.doc_id for r in kept if r.doc_id is not None]
    assert sorted(named) == sorted({g for g in groups if g is not None}) and sum(r.doc_id is None for r in kept) == 2


def test_texts_of_one_id_are_judged_one_by_one(spark):
    a, b = "a text of some words " * 5, "something else entirely here now"
    rows = [(1, a), (5, a), (5, b), (5, b), (7, "third one of its own kind"), (None, a)]
    kept = sorted(((r.doc_id or 0), r.text) for r in simhash.one_per_group(docs(spark, rows)).collect())
    assert kept == sorted([(1, a), (5, b), (7, rows[4][1]), (0, a)])


# --- pipeline

def test_language_stage_needs_evidence(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(i, ("the cat and the dog " if i % 2 else "der hund und die katze ") * 3, "en" if i % 2 else "de", "s", 0) for i in range(60)]
    odd = [(100, "日本語の文", None, "s", 0), (101, "1 2 3", None, "s", 0), (102, "the katze", None, "s", 0), (103, None, None, "s", 0)]
    out = corpus_pipeline.language_id(spark, spark.createDataFrame(rows + odd, schema), "").collect()
    assert sorted(r.doc_id for r in out) == [*range(60), 102]
    unlabelled = spark.createDataFrame([(i, t, None, s, n) for i, t, _, s, n in rows + odd], schema)
    assert corpus_pipeline.language_id(spark, unlabelled, "").count() == 62


def test_stages_against_each_other(spark, sf_dir):
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = spark.createDataFrame(
        [(9001, None, "en", "s", 0), (9002, "12345 !!", None, None, 8), (9003, "Der und the", None, None, 11)], source.schema
    )
    before = source.unionByName(extra)
    texts = {r.doc_id: r.text for r in before.collect()}
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]

    rows = steps["language_id"](spark, before, sf_dir)
    assert rows.columns == source.columns
    assert {r.doc_id: r.text for r in rows.collect()} == {i: t for i, t in texts.items() if any(c.isalpha() for c in t or "")}

    cleaned = {r.doc_id: r for r in steps["line_dedup"](spark, rows, sf_dir).collect()}
    assert all(r.n_chars == len(r.text) and set(r.text.split("\n")) <= {*texts[i].split("\n"), ""} for i, r in cleaned.items())

    table = spark.createDataFrame(list(cleaned.values()), source.schema)
    kept = {r.doc_id for r in steps["near_dedup"](spark, table, sf_dir).collect()}
    listed = [(i, r.text) for i, r in cleaned.items()]
    assert kept == set(brute_groups(listed)[1])

    leaked = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").first().text
    more = spark.createDataFrame([(1, f"before {leaked} after", "en", "s", 0), (2, leaked, "en", "s", 0)], source.schema)
    clean = {r.doc_id: r for r in steps["decontamination"](spark, more, sf_dir).collect()}
    assert list(clean) == [1] and clean[1].text == "before \n" + leaked[len(leaked.rstrip(". \n")):] + " after"

    final = steps["packing"](spark, table, sf_dir).collect()
    assert check_packing(final, dict(listed)) == 0


def test_pipeline_drops_lines_on_few_pages(spark):
    """Lines on 5 of 100 pages, or on 3 of 3, go; those on two pages stay, and copied pages keep their text."""
    rows = [(i, f"rare menu\nbody {i}" if i < 5 else f"twice\nbody {i}" if i < 7 else f"body {i}", "en", "a", 0) for i in range(100)]
    rows += [(200 + i, f"small menu\npage {i}", "en", "b", 0) for i in range(3)]
    rows += [(300 + i, "copied\npage", "en", "c", 0) for i in range(4)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r for r in corpus_pipeline.line_dedup(spark, table, "").collect()}
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out.values())
    assert [out[i].text for i in (0, 5, 200)] == ["body 0", "twice\nbody 5", "page 0"]
    assert {out[300 + i].text for i in range(4)} == {"copied\npage"}


def test_pipeline_runs(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 100
