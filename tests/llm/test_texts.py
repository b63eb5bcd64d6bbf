"""Fingerprints, decontamination, lines, secrets: brute force on small tables and odd rows."""

import hashlib
import random
import re

import numpy as np
import pytest

from barflow.llm import automaton, decontaminate, digests, fmindex, secrets, sitelines
from barflow.llm.frames import importable

DOCS = "doc_id long, text string, source string, bucket int, n_hit int"


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    importable(spark)


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, 1) for i, t, s in rows], DOCS)


# --- fingerprints

def test_fingerprints_follow_descending_ids(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    ordered = sorted(table.collect(), reverse=True)
    by_id = {r.doc_id: r for r in digests.fingerprint_documents(table).collect()}
    assert len(by_id) == len(ordered)
    for a, b in zip(ordered, ordered[1:] + ordered[:1]):
        got, third = by_id[a.doc_id], len(a.text) // 3
        text = a.text[: len(a.text) - third] + b.text[:third]
        assert got.n_chars == len(a.text) and got.edited_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert got.near_next == pytest.approx(digests.likeness_of(got.fingerprint, by_id[b.doc_id].fingerprint))
        assert got.near_edited == pytest.approx(digests.likeness_of(got.fingerprint, got.edited_fingerprint))
    near = [(r.near_edited, r.near_next) for r in by_id.values()]
    assert sum(x for x, _ in near) > sum(y for _, y in near) + 0.3 * len(near)


def test_fingerprint_edges(spark):
    rows = [(3, "abc" * 50, "s"), (2, None, "s"), (2, "", None), (None, "abc" * 50, "s"), (-5, "x", "s"), (9, "longer " * 300_000, "s")]
    out = sorted(digests.fingerprint_documents(docs(spark, rows)).collect(), key=lambda r: (r.doc_id is None, r.doc_id, r.n_chars))
    assert [r.n_chars for r in out] == [1, 0, 0, 150, 2_100_000, 150]
    assert out[3].fingerprint == out[5].fingerprint and out[1].fingerprint == out[2].fingerprint
    assert out[5].edited_sha256 == hashlib.sha256(("abc" * 50)[:100].encode()).hexdigest()
    single = digests.fingerprint_documents(docs(spark, [(1, "abcdef", "s")])).first()
    assert single.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and single.near_next == 1.0
    assert digests.fingerprint_documents(docs(spark, [])).count() == 0


def test_triplets_against_loops(monkeypatch):
    data = [b"", b"abcd", b"abcde", bytes(range(200)) * 3]
    whole = digests.triplet_counts(data)
    assert whole.sum(axis=1).tolist() == [0, 0, len(digests.TRIPLETS), (600 - digests.REACH) * len(digests.TRIPLETS)]
    monkeypatch.setattr(digests, "PIECE", 64)
    assert (digests.triplet_counts(data) == whole).all()


def test_many_buckets_and_batches(spark):
    rows = [(i * 3 % 101, f"text {i} " * 5, "s") for i in range(101)]
    table = docs(spark, rows)
    small = digests.neighbours(table, per_bucket=4).where("not guest").groupBy("bucket").count().collect()
    assert len(small) > 10 and sum(r["count"] for r in small) == 101


# --- decontamination

def brute_hits(text, items):
    lower = lambda t: decontaminate.WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
    words, found = lower(text), set()
    hit = [False] * len(words)
    for item, body in items:
        w = lower(body)
        for i in range(max(1, len(w) - 9) if w else 0):
            window = w[i : i + 10]
            for j in range(len(words) - len(window) + 1):
                if words[j : j + len(window)] == window:
                    found.add(str(item))
                    hit[j : j + len(window)] = [True] * len(window)
    return words, hit, sorted(found)


def test_fm_index_against_search():
    draw = np.random.default_rng(5)
    for n, k in ((1, 1), (40, 1), (500, 3), (3000, 900)):
        text = draw.integers(1, k + 2, n)
        listed = [*text.tolist(), 0]
        assert fmindex.suffix_array(np.append(text, 0)).tolist() == sorted(range(n + 1), key=lambda i: listed[i:])
        index = fmindex.FMIndex(text)
        for m in (1, 2, 4):
            for at in draw.integers(0, max(n - m + 1, 1), 10 if n >= m else 0):
                low, high = index.search(text[None, at : at + m])
                want = [i for i in range(n - m + 1) if listed[i : i + m] == listed[at : at + m]]
                assert sorted(index.locate(np.arange(low[0], high[0]))) == want


@pytest.mark.parametrize("block_chars", [30, 1 << 20])
def test_decontamination_against_brute_force(spark, block_chars, monkeypatch):
    draw = random.Random(3)
    text = lambda n: " ".join(draw.choice(["a", "b", "Été", "c1", "D"]) + draw.choice(["", ",", " -- "]) for _ in range(n))
    items = [(10, text(25)), (9, text(4)), (2, text(12)), (3, ""), (4, None), (5, "zz"), (5, text(11)), (6, text(10))]
    bodies = [text(draw.randrange(60)) for _ in range(60)] + [items[0][1].upper() + " tail", "x zz y zz", None, "", "!!", items[2][1] * 2]
    rows = [(i, b, "s") for i, b in enumerate(bodies)] + [(None, "zz", None), (None, "zz", None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.contamination(docs(spark, rows), benchmark, block_chars=block_chars).collect()
    assert len(out) == len(rows)
    for r in out:
        words, hit, found = brute_hits(r._text_in, items)
        assert (r.n_words, r.n_hit, r["items"]) == (len(words), sum(hit), found)
    full = decontaminate.contaminated_documents(docs(spark, rows), benchmark).where("doc_id = 60").first()
    assert full.contaminated and full.n_items >= 1
    none = benchmark.where("false")
    assert decontaminate.contaminated_documents(docs(spark, rows), none).where("contaminated").count() == 0
    assert decontaminate.contaminated_documents(docs(spark, []), benchmark).count() == 0


def test_benchmark_blocks_are_searched_one_by_one(spark):
    """However many blocks a benchmark has, the plan holds the phrases of the last one; items without an id are not listed."""
    items = [(None, "red green"), (1, "blue"), (None, None), (2, "red green")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").coalesce(1)
    found = decontaminate.contamination(docs(spark, [(1, "Red green blue!", "s"), (2, "red", "s")]), benchmark, block_chars=3)
    assert found._jdf.queryExecution().toString().count("MapInArrow") == 4  # one in each of the four plans printed
    rows = {r.doc_id: r for r in found.collect()}
    assert (rows[1].n_hit, rows[1]["items"]) == (3, ["1", "2"]) and (rows[2].n_hit, rows[2]["items"]) == (0, [])
    alone = decontaminate.contamination(docs(spark, [(1, "red green", "s")]), benchmark.where("item_id IS NULL")).first()
    assert (alone.n_hit, alone["items"]) == (2, [])


def test_spans_are_cut_out(spark):
    item = "one two three four five six seven eight nine ten"
    rows = [(1, f"Keep this. {item.title()}, and that {item}", "s"), (2, "clean é", "s"), (3, item, "s"), (4, None, "s")]
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    marked = decontaminate.contamination(docs(spark, rows), benchmark)
    cut = {r.doc_id: r.t for r in marked.select("doc_id", decontaminate.without_spans("_text_in", "spans").alias("t")).collect()}
    assert cut == {1: "Keep this. \n, and that \n", 2: "clean é", 3: "\n", 4: None}


# --- lines

def test_boilerplate_lines(spark):
    rows = [(i, f"menu \nbody {i}\n\nmenu\nend {i}", "a") for i in range(10)] + [(100 + i, "menu\nx", "b") for i in range(2)]
    rows += [(200, None, "a"), (201, "", "a"), (202, "alone", None)] + [(300 + i, "null host", None) for i in range(6)]
    out = {r.doc_id: r for r in sitelines.clean_documents(docs(spark, rows)).collect()}
    assert out[0].text == "body 0\n\nend 0" and (out[0].n_lines, out[0].n_removed) == (4, 2)
    assert out[100].text == "menu\nx"  # on two pages only
    assert out[200].text is None and out[200].n_lines == 0 and out[201].text == ""
    assert out[202].text == "alone" and out[300].text == ""
    assert sitelines.clean_documents(docs(spark, [])).count() == 0


def test_line_columns_of_any_name(spark):
    rows = [(i, f"menu\npage {i}", "h", 7, "k", "c") for i in range(5)]
    table = spark.createDataFrame(rows, "doc_id long, text string, _host string, _kept int, host string, lines string")
    out = sitelines.drop_boilerplate(table, host="_host").orderBy("doc_id").collect()
    assert [tuple(r) for r in out] == [(i, f"page {i}", "h", 7, "k", "c", 2, 1) for i in range(5)]


def test_lines_at_the_ratio_and_long_lines(spark):
    rows = [(i, ("at the ratio\n" if i < 3 else "over\n" if i < 7 else "") + "x" * 200_000 + str(i), "a") for i in range(300)]
    out = {r.doc_id: r.n_removed for r in sitelines.clean_documents(docs(spark, rows)).collect()}
    assert [out[i] for i in (0, 3, 7)] == [0, 1, 0]


# --- secrets

ASSIGN = re.compile(secrets.ASSIGN.replace(r"\x20", " ") + "([A-Za-z0-9+/_.=-]+)", re.ASCII)
BASE = [
    ("assign", ASSIGN, lambda m: len(m[1]) >= 8), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32),
]


def brute_secrets(text):
    found = [(m.start(), k, n, m.end()) for k, (n, p, ok) in enumerate(BASE) for m in p.finditer(text) if ok(m)]
    return [(n, s, e) for s, _, n, e in sorted(found)]


def test_secrets_against_regexes():
    draw = random.Random(1)
    bits = ["password", "Token", "api_key", "APIKEY", "secret", "passwd", "=", ":", " ", "'", '"', "AKIA", "ABCDEFGH12", "deadbeef",
            "0123456789abcdef", "0123456789abcdef", "abc.def", "x", "\n", "é", "==", "-", "日本"]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randrange(30))) for _ in range(6000)] + [None, "", "a" * 31, "a" * 32]
    texts += ['token="token"="token=abcdefghij', 'token="token"="abcdefghij', "secret = token: '" + "x" * 90_000]
    for text, found in zip(texts, secrets.find_secrets(secrets.Scanner(), texts)):
        assert [f for f in found if f[0] in ("assign", "access", "hex")] == brute_secrets(text or "")


def test_private_keys_and_hosting_against_regexes():
    draw = random.Random(2)
    rules = [(k, re.compile(r.pattern)) for k, r in enumerate(secrets.RULES) if k >= secrets.BASE]
    bits = ["-----BEGIN ", "RSA ", "PRIVATE KEY", "-----", "-", "END ", "ghp_", "gho_", "A1b2C3d4E5f6" * 3, "é", "\n", "token=", "x"]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randrange(25))) for _ in range(3000)]
    some = 0
    for text, found in zip(texts, secrets.find_secrets(secrets.Scanner(), texts)):
        want = []
        for k, rule in rules:
            for m in rule.finditer(text):
                tail = re.search(f"{secrets.RULES[k].tail}+$", m[0])[0] if k == secrets.BASE else m[0][4:]
                if len(tail) >= secrets.RULES[k].least:
                    want.append((m.start(), k, secrets.RULES[k].kind, m.end()))
        some += bool(want)
        assert [f for f in found if f[0] in ("private_key", "hosting")] == [(n, s, e) for s, _, n, e in sorted(want)]
    assert some > 100


def test_automaton_states_do_not_depend_on_lanes(monkeypatch):
    machine = automaton.compile_rules(["ab+c", "(?i:key)[=:]x{2,3}"])
    data = (b"abbbbc key=xxx KEY:xx\nabc zabab" * 40)[:-3]
    whole = machine.states(data)
    monkeypatch.setattr(automaton, "LANES", 1)
    assert (machine.states(data) == whole).all()
    ends = [i for i in range(len(data)) if re.search(rb"(ab+c|(?i:key)[=:]x{2,3})\Z", data[max(0, i - 12) : i + 1])]
    assert np.flatnonzero(whole >= machine.first_accepting).tolist() == ends


def test_secret_rows(spark):
    key = "-----BEGIN RSA PRIVATE KEY-----"
    rows = [(1, f"é password = 'abcdefgh1' {key}", "s"), (2, None, "s"), (None, "AKIA" + "B" * 12, "s"), (3, "f" * 100_000, "s")]
    out = {r.doc_id: r for r in secrets.scan_documents(docs(spark, rows)).collect()}
    base = "assign:2:23"
    assert out[1].spans == f"{base},private_key:25:56" and out[1].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert (out[2].spans, out[None].n_access, out[3].n_hex) == ("", 1, 1)
    assert secrets.scan_documents(docs(spark, [])).count() == 0
    spans = secrets.scan(docs(spark, rows[:1])).first().secrets
    assert [(s.kind, s.start, s.end) for s in spans] == [("assign", 2, 23), ("private_key", 25, 56)]
