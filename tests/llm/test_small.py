"""Odd rows and small fixtures for every operator, against brute force where there is any."""

import base64
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import public_tokenizers
from tallymark.llm import bpe, ego, graph, langid, lmscore, minhash, pii, secrets, shingles, templates, tokens, toxicity, trigrams
from tallymark.llm.common import Scratch, slices

DOCS = "doc_id long, text string, lang string, source string, n_chars long, band int, hash long, score double, kept string"
ODD = [
    (1, "the cat sat on the mat and the dog ran", "en"),
    (2, None, "en"),
    (3, "", None),
    (None, "the cat sat on the mat and the dog ran", "en"),
    (5, "le chat est sur la table et le chien", "fr"),
    (5, "le chat est sur la table et le chien", "fr"),
    (6, "word " * 30_000, "en"),
    (7, "12345 !!! \n\t ", None),
    (8, "the cat sat on the mat and the dog ran", "en"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, lang, None, None, 1, 2, 0.5, "x") for i, t, lang in ODD], DOCS).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.where(F.lit(False))


def words(n, seed, pool=400):
    r = random.Random(seed)
    return [f"w{r.randrange(pool)}" for _ in range(n)]


def test_slices_cover_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 700_000, None, "y" * 700_000, "z" * 3_000_000, "", "a"])], names=["text"])
    assert [p.num_rows for p in slices([batch])] == [2, 1, 1, 2]


def brute_components(n, edges):
    label = list(range(n))
    for _ in range(n):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    return label


@pytest.mark.parametrize("task_edges", [1_000_000, 5])
def test_components_of_random_graphs_and_a_chain(spark, task_edges):
    r = random.Random(3)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(60, 79)]
    want = brute_components(80, edges)
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {x.node: x.component for x in graph.components(frame, Scratch(spark, "t"), task_edges).collect()}
    assert got == {n: want[n] for e in edges if e[0] != e[1] for n in e}
    assert graph.components(frame.where("a < 0"), Scratch(spark, "t"), task_edges).count() == 0


# --- token counts


@pytest.mark.parametrize("largest", [1 << 28, 1_000])
def test_separator_scan_of_flat_files(spark, tmp_path, monkeypatch, largest):
    monkeypatch.setattr(tokens, "LARGEST", largest)
    r = np.random.default_rng(5)
    want = []
    for f, lengths in enumerate(([0, 70_000, 3, 140_000, 0, 1], [65_535, 65_536, 0])):
        ids = np.concatenate([np.append(r.integers(0, 50_000, n), tokens.SEPARATOR) for n in lengths] + ([np.array([7, 7])] if f else [])).astype(tokens.DTYPE)
        ids.tofile(tmp_path / f"{f}.bin")
        start = 0
        for k, n in enumerate(lengths):
            want.append((f, k, start, n, True))
            start += n + 1
        want += [(f, len(lengths), start, 2, False)] if f else []
    (tmp_path / "2.bin").write_bytes(b"")
    got = tokens.separator_scan(tokens.blocks_of_files(spark, f"file://{tmp_path}")).collect()
    assert sorted((int(x.file[-5]), x.ordinal, x.start, x.n_tokens, x.terminated) for x in got) == sorted(want)


def test_token_counts_of_odd_rows(spark, docs, none):
    got = tokens.token_counts(docs).collect()
    assert len(got) == len(ODD) and all(x.terminated for x in got)
    assert {x.n_tokens for x in got if x.doc_id in (2, 3)} == {0}
    assert tokens.token_counts(none).count() == 0


# --- byte-level BPE


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'sa.1éß😀\x1c\x85\xa0　")), max_size=40))
def test_ids_equal_the_rank_files_own(reference, text):
    c = bpe.codec()
    ids = c.encode([text])[0]
    assert ids == reference.encode_ordinary(text)
    assert c.decode_bytes(ids) == text.encode()
    starts, ends = c.offsets(text, ids) if ids else ([], [])
    assert all(0 <= s < e <= len(text) for s, e in zip(starts, ends)) and (not ids or (starts[0], ends[-1]) == (0, len(text)))


def test_special_strings_are_text_and_digests_match(spark, docs, none, reference):
    assert bpe.codec().encode(["<|endoftext|>"])[0] == reference.encode_ordinary("<|endoftext|>")
    got = bpe.digests(docs).collect()
    want = []
    for i, t, _ in ODD:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.digests(none).count() == 0


def test_encode_then_decode(spark):
    frame = spark.createDataFrame([(1, "né 😀!"), (2, None)], "doc_id long, text string")
    coded = bpe.encode(frame)
    assert {r.doc_id: r.text for r in bpe.decode(coded).collect()} == {1: "né 😀!", 2: ""}
    split = coded.where("doc_id = 1").select("doc_id", F.slice("ids", 1, F.size("ids") - 2).alias("ids"))
    assert "�" in bpe.decode(split).first()["text"]


# --- near duplicates


def brute_near(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    ids = sorted(sets)
    at = {d: k for k, d in enumerate(ids)}
    edges = [(at[a], at[b]) for a in ids for b in ids if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    label = brute_components(len(ids), edges)
    return {d: (len(sets[d]), ids[label[at[d]]]) for d in ids}


def edited(base, n, seed):
    r, out = random.Random(seed), list(base)
    for _ in range(n):
        out[r.randrange(len(out))] = f"e{r.randrange(50)}"
    return " ".join(out)


def test_near_duplicates_equal_brute_force(spark):
    base = words(80, 1)
    rows = [(i, edited(base, i % 6, i)) for i in range(60)] + [(100 + i, " ".join(words(40, i))) for i in range(20)]
    rows += [(200, "A b"), (201, "a B"), (202, "a b c d e f"), (203, "a b c d e f"), (204, ""), (205, None), (206, " \t\n"), (207, "a b c d e f g h"), (208, "x é")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute_near(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_write_few_files_out_of_many_partitions(spark, monkeypatch):
    files, save = [], Scratch.save

    def counted(self, *args, **kwargs):
        out = save(self, *args, **kwargs)
        files.append(len(out.inputFiles()))
        return out

    base, conf = words(80, 3), {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    rows = [(i, edited(base, i % 6, i)) for i in range(60)] + [(100 + i, " ".join(words(40, 50 + i))) for i in range(20)]
    before = {k: spark.conf.get(k) for k in conf}
    monkeypatch.setattr(Scratch, "save", counted)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == brute_near(rows)
    # Only the classes and their texts, of which little is known before, may have a file a partition.
    assert sum(n > 2 * spark.sparkContext.defaultParallelism for n in files) <= 2, files


def test_near_duplicates_of_odd_rows(docs, none):
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == len(ODD)
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(1, 1, True), (8, 1, False), (2, 2, True), (3, 3, True), (None, None, True), (5, 5, True), (6, 6, True), (7, 7, True)}
    assert minhash.near_duplicates(none).count() == 0


def test_near_duplicates_of_one_id_with_unequal_texts(spark):
    a, b = " ".join(words(40, 1)), " ".join(words(40, 2))
    rows = [(3, a), (5, a), (5, b), (5, b), (6, b), (7, b + " end")]
    frame = spark.createDataFrame([(*r, 1, 2, 0, "x") for r in rows], "doc_id long, text string, key long, bucket long, rep long, body string")
    got = sorted(tuple(r) for r in minhash.near_duplicates(frame).select("doc_id", "component_id", "kept").collect())
    assert got == [(3, 3, True), (5, 3, False), (5, 5, True), (5, 5, True), (6, 5, False), (7, 5, False)]


def test_registers_estimate_similarity():
    r = np.random.default_rng(1)
    pool = r.integers(0, 2**63, 3000).astype(np.uint64)
    regs = minhash.registers([pool[:2000], pool[500:2500]])
    n = np.array([2000.0])
    assert minhash.estimate(regs[:1], regs[1:], n, n)[0] == pytest.approx(0.6, abs=0.15)


def test_parity_sketch_never_rules_out_a_link():
    r = np.random.default_rng(2)
    for _ in range(50):
        n = int(r.integers(1, 400))
        a = r.integers(0, 2**63, n).astype(np.uint64)
        b = np.concatenate([a[: n - n // 8], r.integers(0, 2**63, n // 9).astype(np.uint64)])
        odd = [np.bincount((x >> np.uint64(64 - minhash.ODD_BITS)).astype(np.int64), minlength=minhash.ODD) & 1 for x in (a, b)]
        assert (odd[0] != odd[1]).sum() <= len(np.setxor1d(a, b))


# --- near vectors


def test_near_vectors_equal_brute_force(spark, monkeypatch):
    r = np.random.default_rng(7)
    centres = r.normal(size=(6, 12))
    rows = []
    for i in range(700):
        v = centres[r.integers(6)] + r.normal(size=12) * r.choice([0.0, 0.05, 0.15, 2.0])
        rows.append((i, [float(np.float32(x)) for x in v], int(r.integers(2))))
    rows += [(1000, None, 1), (1001, [0.0] * 12, 1), (1002, [float("nan")] * 12, 1), (1003, [float("inf")] + [0.0] * 11, 0), (1004, rows[0][1], None), (1005, rows[0][1], rows[0][2]), (1006, [1e-30] * 12, 1), (1007, [1e30] * 12, 1), (1008, [1.0] * 5, 1), (1009, [], 1), (1010, [None] + [1.0] * 11, 1)]
    frame = spark.createDataFrame([(*x, "e") for x in rows], "vec_id long, embedding array<float>, label int, n_links string")
    got = {x.vec_id: x for x in ego.near_vectors(frame).collect()}
    assert len(got) == len(rows)
    ok = {i: (np.array(v, float) / np.linalg.norm(np.array(v, float) / np.abs(v).max()) / np.abs(v).max(), y) for i, v, y in rows if v and None not in v and np.isfinite(v).all() and any(v) and y is not None}
    ids = sorted(ok)
    edges = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if ok[a][1] == ok[b][1] and len(ok[a][0]) == len(ok[b][0]) and ok[a][0] @ ok[b][0] >= 0.98]
    label = brute_components(1011, edges)
    for i in got:
        assert (got[i].n_links, got[i].component_id) == (sum(i in e for e in edges), label[i]), i
    assert ego.near_vectors(frame.limit(0)).count() == 0


def test_near_vectors_of_one_id_with_unequal_vectors(spark):
    rows = [(5, [1.0, 0.0, 0.0], 1), (5, [0.0, 1.0, 0.0], 1), (6, [1.0, 0.01, 0.0], 1), (7, [0.0, 1.0, 0.01], 1), (8, [0.0, 1.0, 0.02], 1)]
    got = ego.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(5, 1, 5), (5, 2, 5), (6, 1, 5), (7, 2, 5), (8, 2, 5)]


@pytest.mark.parametrize("block, tile", [(4, 2), (16, 3)])
def test_near_vectors_in_small_blocks_and_tiles(spark, monkeypatch, block, tile):
    monkeypatch.setattr(ego, "BLOCK", block)
    monkeypatch.setattr(ego, "TILE", tile)
    r = np.random.default_rng(11)
    x = r.normal(size=(5, 6))[r.integers(5, size=300)] + r.normal(size=(300, 6)) * r.choice([0.02, 0.1, 1.0], size=(300, 1))
    frame = spark.createDataFrame([(i, v.tolist(), i % 2) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label long")
    got = {q.vec_id: (q.n_links, q.component_id) for q in ego.near_vectors(frame).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = (u @ u.T >= 0.98) & (np.arange(300)[:, None] % 2 == np.arange(300)[None] % 2)
    np.fill_diagonal(linked, False)
    label = brute_components(300, list(zip(*np.nonzero(linked))))
    assert got == {i: (int(linked[i].sum()), label[i]) for i in range(300)}


# --- toxicity


def test_toxicity_learns_and_survives_odd_rows(spark, docs, none):
    r = random.Random(4)
    rows = [(i, " ".join(words(60, i) + (["zorblax", "grumfute"] * 2 if i % 4 == 0 else []))) for i in range(400)]
    r.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = frame.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    got = {x.doc_id: x for x in toxicity.score_toxicity(frame, labels).collect()}
    held = [x for x in got.values() if x.held_out]
    assert len(held) > 40 and np.mean([x.predicted == (x.doc_id % 4 == 0) for x in held]) > 0.95
    assert all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.5) for x in got.values())
    odd = toxicity.score_toxicity(docs, labels).collect()
    assert len(odd) == len(ODD) and all(x.score is not None for x in odd)
    assert {x.score for x in toxicity.score_toxicity(docs, labels.limit(0)).collect()} == {0.5}
    assert toxicity.score_toxicity(none, labels).count() == 0


def test_toxicity_keeps_the_class_prior_when_a_class_is_cut(spark, monkeypatch):
    # The same words in both classes: only the prior, 1 in 10, is left to learn, however few ordinary documents are read.
    monkeypatch.setattr(toxicity, "SAMPLE_DOCS", 60)
    frame = spark.createDataFrame([(i, " ".join(words(30, i % 7))) for i in range(600)], "doc_id long, text string")
    labels = frame.select("doc_id", (F.col("doc_id") % 10 == 0).cast("int").alias("toxic"))
    got = toxicity.score_toxicity(frame, labels).collect()
    assert abs(np.mean([x.score for x in got]) - 0.1) < 0.05 and not any(x.predicted for x in got)


# --- language identification


def test_language_backs_off_and_survives_odd_rows(spark, docs, none):
    model = langid.fit(docs)
    assert model.languages == ["en", "fr"]
    assert model.predict("the cats and the mats")[0] == "en" and model.predict("les chats et les tables")[0] == "fr"
    assert model.predict("chien")[0] == "fr" and "chiens" not in model.words and model.predict("chiens")[0] == "fr"
    assert model.predict("123 !") == ("und", 0.0) and model.predict(None) == ("und", 0.0)
    got = langid.identify(docs).collect()
    assert len(got) == len(ODD) and {x.lang_pred for x in got if x.doc_id in (2, 3, 7)} == {"und"}
    assert all(0 <= x.score <= 1 for x in got)
    assert {x.lang_pred for x in langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.identify(none).count() == 0


def test_a_rare_language_is_learned_and_repeats_stay_within_the_bound(spark):
    rows = [(i, f"the cat and the dog of house {'abcdefghijklmnopqrst'[i]}", "en") for i in range(20)] + [(99, "zqx wvk jqz", "xx")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(frame)
    assert model.languages == ["en", "xx"] and model.predict("zqx")[0] == "xx" and model.predict("jq")[0] == "xx"
    assert model.predict("Ελλάδα") == ("en", 0.5)
    repeated = frame.union(frame.where("doc_id = 99").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("k"))
    assert langid.sampled(repeated, 10_000).count() == len(rows) and langid.sampled(repeated, 5).count() < 25


def test_repeats_erase_no_language(spark, monkeypatch):
    """One row a hundred thousand times and a few rows of another language: both are learned, the few rows all kept."""
    monkeypatch.setattr(langid, "SAMPLE_DOCS", 60)
    french = spark.createDataFrame([(i, f"le chat et le chien de la maison {w}", "fr") for i, w in enumerate(words(40, 9))], "doc_id long, text string, lang string")
    english = spark.range(100_000).select(F.lit(500).cast("long").alias("doc_id"), F.lit("the cat and the dog").alias("text"), F.lit("en").alias("lang"))
    german = spark.range(300).select((F.col("id") + 1000).alias("doc_id"), F.concat(F.lit("die katze und der hund "), F.col("id")).alias("text"), F.lit("de").alias("lang"))
    frame = french.union(english).union(german)
    got = {r["lang"]: r["count"] for r in langid.sampled(frame, 60, "lang").groupBy("lang").count().collect()}
    assert got["en"] == 1 and got["fr"] > 15 and 15 < got["de"] < 50
    model = langid.fit(frame)
    assert model.languages == ["de", "en", "fr"] and model.predict("the dog")[0] == "en" and model.predict("und der")[0] == "de"
    short = langid.sampled(frame, 10_000, "lang", most_bytes=3 * 200).groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n")).collect()
    assert {r["lang"] for r in short} == {"de", "en", "fr"} and all(r["n"] <= 200 for r in short)


def test_levels_fill_up():
    assert langid.level([1, 2, 100], 33) == 30 and langid.level([5, 5], 100) == 5 and langid.level([10, 10], 10) == 5 and langid.level([], 5) == 0


def brute_language(model, text):
    """Word by word, straight from the definition."""
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    total, n = np.zeros(len(model.languages)), 0
    for w in words:
        rows = [model.words[w]] if w in model.words else next((f for k in range(5, 0, -1) if (f := [model.grams[g] for g in langid.grams(w, k) if g in model.grams])), [])
        if rows:
            total, n = total + model.scores[rows].mean(axis=0), n + 1
    if not words:
        return "und", 0.0
    total = np.exp(total / np.sqrt(max(n, 1)))
    return model.languages[int(total.argmax())], total.max() / total.sum()


def test_language_equals_brute_force(spark, docs):
    model, r = langid.fit(docs), random.Random(8)
    rows = ["".join(r.choice(["the", "chat", "Dog", "chiens", "table", "x1y", " ", " ", "\t", "é", "-", "7", "Σ"]) for _ in range(r.randrange(30))) for _ in range(200)]
    for got, score, text in zip(*model.predict_all(pa.array(rows)), rows):
        want, share = brute_language(model, text)
        assert score == pytest.approx(share) and (got == want or score == pytest.approx(0.5)), text


# --- secrets


BASE = (("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12), ("access", r"AKIA[A-Z0-9]+", 0, 18), ("hex", r"[0-9a-f]+", 0, 16))


def brute_secrets(text):
    found = [(m.start(), k, kind, m.end()) for k, (kind, p, g, n) in enumerate(BASE) for m in re.finditer(p, text, re.I | re.A if k == 0 else 0) if len(m.group(g)) >= n]
    return ",".join(f"{kind}:{a}:{z}" for a, _, kind, z in sorted(found))


FRAGMENTS = ["password", "Token", "API_KEY", "apikey", "secret", "passwd", ":", "=", " ", '"', "'", "abcdefghijkl", "short", "AKIA", "AKIAABCDEFGHIJKLMN", "deadbeef", "0123456789abcdef", "é", "😀", "\n", "-", ".", "X"]


def test_secrets_equal_brute_force(spark, docs, none):
    r = random.Random(9)
    rows = [(i, "".join(r.choice(FRAGMENTS) for _ in range(r.randrange(40)))) for i in range(1500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x for x in secrets.report(frame).collect()}
    for i, t in rows:
        want = brute_secrets(t)
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), t
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(len(re.findall(k, want)) for k, *_ in BASE)
        assert set(filter(None, want.split(","))) <= set(got[i].spans.split(","))
    assert secrets.report(docs).count() == len(ODD) and secrets.report(none).count() == 0


def test_trigram_queries_admit_every_match():
    for rule in secrets.RULES:
        assert (trigrams.trigram_query(rule.pattern) is None) == (rule.kind == "hex")
    q = trigrams.trigram_query("ab(cd|ef)+gh?")
    admits = lambda t: all(any(all(x in t for x in o) for o in c) for c in q or ())
    assert admits("abcdg") and admits("abefefgh")
    assert trigrams.trigram_query("[a-z]+") is None


def test_postings_meet_exactly_the_rules_queries(spark):
    r = random.Random(10)
    pool = [*FRAGMENTS, "ghp_", "xoxb-", "sk_live_", "eyJ", "://", "-----BEGIN ", "PRIVATE KEY-----"]
    rows = [(i, "".join(r.choice(pool) for _ in range(r.randrange(12)))) for i in range(400)]
    names = secrets.vocabulary()
    postings = secrets.index(spark.createDataFrame(rows, "key long, text string"), names)
    got = {x.key: x.rules for x in secrets.candidates(postings, secrets.RULES, names).collect()}
    queries = [trigrams.trigram_query(rule.pattern) for rule in secrets.RULES]
    for i, t in rows:
        want = sum(1 << k for k, q in enumerate(queries) if q and all(any(all(x in t.lower() for x in o) for o in c) for c in q))
        assert got.get(i, 0) == want, t


def test_many_secrets_of_one_text_keep_their_places(spark):
    text = "é password=abcdefghijklmnop " * 3_000
    got = secrets.report(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert got.n_assign == 3_000 and got.base_sha256 == hashlib.sha256(brute_secrets(text).encode()).hexdigest()


# --- personal data


def test_personal_data_is_searched_for_once(spark):
    texts = ["г-н Иван Петров und Dr. Ana Sol. Sol rief.", "nothing here", None, "éMr Bo Ni, _x@y.de"]
    out = pii.pseudonymise(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "k")
    assert "regexp_extract_all" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {r.doc_id: r for r in out.collect()}
    assert [got[i].n_person for i in range(4)] == [3, 0, 0, 0] and [got[i].text for i in (1, 2)] == texts[1:3]


def test_surrogates_keep_type_and_coreference(spark, docs, none):
    rows = [(1, "Mr. John Smith, j.smith1@mail.example.com, card 4111 1111 1111 1111"), (2, "Mrs. Smith; J.Smith1@mail.example.com 4111111111111111 from 10.1.2.3"), (3, "г-н Иван Петров +1 (663) 555-6869"), (4, None)]
    got = {r.doc_id: r for r in pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    family = re.search(r"Mr\. \S+ (\w+),", got[1].text)[1]
    assert f"Mrs. {family};" in got[2].text and "Smith" not in got[1].text + got[2].text
    mail = [re.search(r"\S+@\S+?\.com", got[i].text)[0] for i in (1, 2)]
    assert mail[0] == mail[1] != "j.smith1@mail.example.com"
    card = re.search(r"card (\d{4} \d{4} \d{4} \d{4})", got[1].text)[1]
    assert card.replace(" ", "") in got[2].text and sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(card.replace(" ", "")))) % 10 == 0
    assert re.fullmatch(r"г-н [Ѐ-ӿ]+ [Ѐ-ӿ]+ \+\d \(\d{3}\) \d{3}-\d{4}", got[3].text)
    assert got[4].text is None and (got[1].n_person, got[2].n_ip, got[3].n_phone) == (1, 1, 1)
    assert pii.pseudonymise(docs, "k").count() == len(ODD) and pii.pseudonymise(none, "k").count() == 0


PHONES = ["+44 20 7946 0958", "01 23 45 67 89", "+33 1 23 45 67 89", "+49 30 1234567", "+34 912 345 678", "5551234567", "030 1234567", "(030) 123 4567", "612 34 56 78"]
CARDS = ["3782 822463 10005", "378282246310005", "3056 930902 5904", "4222222222222", "6304 0000 0000 0000 018"]
IPS = ["2001:db8:0:0:0:ff00:42:8329", "2001:DB8::ff00:42:8329", "fe80::1", "::1"]


def test_surrogates_cover_the_forms_of_each_kind(spark):
    forms = [("n_phone", f) for f in PHONES] + [("n_card", f) for f in CARDS] + [("n_ip", f) for f in IPS]
    beside = (300, "+44 20 7946 0958 10.1.2.3 +1 (663) 555-6869 10.1.2.4")
    plain = ["order 4222222222223 of 12:30:45", "std::vector at 1712345678", "12 345 678.90 of 2023-04-05"]
    rows = [(i, f"see {f}, then") for i, (_, f) in enumerate(forms)] + [(100 + i, t) for i, t in enumerate(plain)]
    rows.append(beside)
    rows.append((200, "Mrs. Ada Quill met Peter Zorn. Later Quill and Zorn left; Ada stayed. Quillon too. Dr. Quill"))
    got = {r.doc_id: r for r in pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    for i, (kind, f) in enumerate(forms):
        assert got[i][kind] == 1 and f not in got[i].text, f
        if kind != "n_ip":
            assert re.sub(r"\d", "0", got[i].text) == f"see {re.sub(r'[0-9]', '0', f)}, then", f
    assert got[0].text.startswith("see +44 ") and got[3].text.startswith("see +49 ") and got[1].text.startswith("see 0")
    assert [got[100 + i].text for i in range(len(plain))] == plain
    assert (got[300].n_ip, got[300].n_phone) == (2, 2)
    m = re.fullmatch(r"Mrs\. (\S+) (\S+) met (\S+) (\S+)\. Later (\S+) and (\S+) left; (\S+) stayed\. Quillon too\. Dr\. (\S+)", got[200].text)
    assert (m[5], m[6], m[7], m[8]) == (m[2], m[4], m[1], m[2]) and not {"Ada", "Quill", "Peter", "Zorn"} & set(m.groups())


def test_colliding_entities_stay_distinct(spark):
    # More addresses of one letter than half the alphabet: first surrogates must collide.
    rows = [(i, f"{c}@x.yz") for i, c in enumerate("abcdefghijklmno")]
    out = [r.text for r in pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()]
    assert len(set(out)) == len(rows) and not set(out) & {t for _, t in rows}


def test_surrogates_end_when_short_forms_run_out(spark):
    # 400 of the 676 addresses of one letter each: no such surrogate is left for all of them.
    rows = [(i, f"{'abcdefghijklmnopqrst'[i // 20]}@{'abcdefghijklmnopqrst'[i % 20]}.com") for i in range(400)]
    out = [r.text for r in pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()]
    assert len(set(out)) == 400 and not set(out) & {t for _, t in rows} and all(re.fullmatch(r"[a-z]+@[a-z]\.com", t) for t in out)


LONG = 1_000_000
ADVERSE = ["a@" + "a." * (LONG // 2) + "com end", "a" * LONG + "@b.com", "a@" * (LONG // 2), "1" * LONG, "1 " * (LONG // 2), "1234 " * (LONG // 5), "+1 " * (LONG // 3), "ab:" * (LONG // 3), ":" * LONG]
ADVERSE += ["DE12 " + "ABCD " * (LONG // 5), "Mr " * (LONG // 3), "Mr. John " * (LONG // 9), "Adam " * (LONG // 5), "Mr. A" + "-" * LONG, "(" * LONG, "1." * (LONG // 2)]
ADVERSE += ["token=" * (LONG // 6), "AKIA" * (LONG // 4), "eyJ" * (LONG // 3), "eyJaaaaaaaa." * (LONG // 12), "://a:b" * (LONG // 6), "-----BEGIN " * (LONG // 11), "-----BEGIN A PRIVATE KEY-----" + "a" * LONG, "xoxb-" * (LONG // 5), "ghp_" + "a" * LONG]


@pytest.mark.parametrize("at", range(len(ADVERSE)))
def test_long_adverse_texts_do_not_end_the_task(spark, at):
    frame = spark.createDataFrame([(1, ADVERSE[at])], "doc_id long, text string")
    found = frame.select(F.size(F.regexp_extract_all("text", F.lit(pii.COMBINED), F.lit(0))).alias("n"), *[F.size(F.regexp_extract_all("text", F.lit(secrets._scanned(r)), F.lit(0))).alias(r.kind) for r in secrets.RULES])
    assert found.first()["n"] is not None


def test_surrogates_equal_in_all_documents_and_distinct(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    before = {r.doc_id: r.text or "" for r in docs.collect()}
    after = {r.doc_id: r.text or "" for r in pii.pseudonymise(docs, "k").collect()}
    kinds = {"email": r"[\w.+-]+@[\w-]+(?:\.[\w-]+)*\.[A-Za-z]{2,}", "card": r"(?<![\w+])\d{16}(?!\w)", "phone": r"\+1 \(\d{3}\) \d{3}-\d{4}"}
    for p in kinds.values():
        fake: dict = {}
        for i, t in before.items():
            own, new = re.findall(p, t), re.findall(p, after[i])
            assert len(own) == len(new)
            for a, b in zip(own, new):
                assert fake.setdefault(a.lower(), b) == b and a.lower() != b
        assert len(set(fake.values())) == len(fake) and not set(fake) & set(fake.values())


# --- decontamination


def test_templates_catch_new_numbers_and_names(spark, docs, none):
    item = "One day Tom buys 12 apples for 3 dollars each at the shop near home. How many dollars does Tom pay for all of the apples?"
    rows = [
        (1, "Well then. " + item + " Thanks"),
        (2, item.replace("Tom", "Alice").replace("12", "45").replace("3 d", "7 d")),
        (3, item.replace("does Tom", "does Bob")),
        (4, "One day we went to the shop near home and paid for all of the apples in dollars"),
        (5, None),
    ]
    items = spark.createDataFrame([(9, item), (9, item), (8, None), (7, "too short"), (None, item)], "item_id long, text string")
    got = {r.doc_id: r for r in templates.alignments(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert set(got) == {1, 2} and got[1].verbatim and not got[2].verbatim
    assert templates.alignments(docs, items).count() == 0 and templates.alignments(none, items).count() == 0 and templates.alignments(docs, items.limit(0)).count() == 0
    assert templates.decontaminate(docs, items).columns == docs.columns and templates.decontaminate(docs, items).count() == len(ODD)


def test_verbatim_copies_match_without_templates(spark):
    named = "The dog of Tom met Ann and the cat of Joe saw Sue while Max and Kim sang for Lee at noon"
    items = spark.createDataFrame([(1, named), (2, "2 + 2 = 4"), (3, "Tall ships sail"), (4, "今日は天気がいいから散歩に行きましょう")], "item_id long, text string")
    rows = [(1, f"so {named.lower()} then"), (2, f"SO {named.upper()} THEN"), (3, "2 + 2 = 4."), (4, "TALL SHIPS SAIL!"), (5, "さて今日は天気がいいから散歩に行きましょうと言う"), (6, "tall old ships sail at 2 + 3 = 5 今日は雨")]
    # Items of a few words are nothing to look for within a text.
    rows += [(7, "as 2 + 2 = 4, we see tall ships sail")]
    got = {(r.doc_id, r.item_id): r for r in templates.alignments(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert set(got) == {(1, 1), (2, 1), (3, 2), (4, 3), (5, 4)} and all(r.verbatim for r in got.values())


def test_texts_of_one_id_are_searched_apart(spark):
    """Two halves of an item under one id make no whole, and a clean text stays beside a leaked one of its id."""
    item = " ".join(f"word{i}x" for i in "abcdefghijklmnopqrst")
    w = item.split()
    items = spark.createDataFrame([(1, item), (2, "Paris"), (3, "The")], "item_id long, text string")
    halves = [(7, " ".join(w[:9] + ["other"] * 11)), (7, " ".join(["thing"] * 9 + w[9:])), (8, "The man saw Paris"), (9, "a clean text of some words"), (9, f"so {item}")]
    frame = spark.createDataFrame(halves, "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in templates.alignments(frame, items).collect()} == {(9, 1)}
    assert sorted(map(tuple, templates.decontaminate(frame, items).collect())) == sorted(halves[:4])


def brute_alignments(rows, items):
    """Pairs of which some diagonal covers enough of the item's template with one value for each slot; words by hand."""
    def tokens(text):
        out, start, named, numbered = [], True, False, False
        for word in text.split():
            core = re.sub(r"^\W+|\W+$", "", word)
            if core:
                low = core.lower()
                number = bool(re.fullmatch(r"\d[\d.,]*", core))
                name = core[0].isupper() and not number and not start
                if not (name and named):
                    unit = numbered and low in templates.UNITS
                    out.append(("#", low) if number else ("@", low) if name else ("%", None) if unit else (low, None))
                named, numbered = name, number
            start = word[-1:] in ".!?"
        return out

    found = set()
    for i, t in rows:
        d = tokens(t)
        for k, u in items:
            b = tokens(u)
            for shift in range(-len(b), len(d)):
                same = [j for j in range(len(b)) if 0 <= j + shift < len(d) and b[j][0] == d[j + shift][0]]
                runs = [r for r in range(len(b) - 7) if all(j in same for j in range(r, r + 8)) and sum(b[j][0] not in "#@%" for j in range(r, r + 8)) >= 3]
                covered = {j for r in runs for j in range(r, r + 8)}
                slots = {(b[j][1], d[j + shift][1]) for j in covered if b[j][1]}
                if len(covered) >= min(13, -(-len(b) * 8 // 10)) and len(slots) == len({s for s, _ in slots}):
                    found.add((i, k))
    return found


def test_new_parameters_equal_brute_force(spark):
    r = random.Random(21)
    pool = "she buys some apples for each of them at the shop near home and pays in coins while it rains over town how many does he have now".split()
    value = lambda: r.choice([str(r.randrange(2, 99)), r.choice(["Tom", "Ann", "Joe", "Sue"]), f"{r.randrange(2, 9)} hours"])
    shapes = [["once"] + [r.choice(pool) if r.random() < 0.75 else None for _ in range(r.randrange(15, 30))] for _ in range(12)]
    fill = lambda shape: " ".join(value() if w is None else w for w in shape) + "."
    items = [(k, fill(s)) for k, s in enumerate(shapes)]
    rows = []
    for i in range(240):
        shape = list(r.choice(shapes))
        if i % 3 == 0:
            shape = shape[: r.randrange(8, len(shape) + 1)]
        given = [(w, value()) for w in "abcd"] if i % 2 else None
        text = fill(shape) if given is None else re.sub(r"Tom|Ann|Joe|Sue", lambda m: {"Tom": "Max", "Ann": "Eve", "Joe": "Lou", "Sue": "Ida"}[m[0]], items[shapes.index(next(s for s in shapes if s[: len(shape)] == shape))][1])
        rows.append((i, "well so it goes " + text + " and that was all of it"))
    make = lambda x, c: spark.createDataFrame(x, f"{c} long, text string")
    got = {(x.doc_id, x.item_id) for x in templates.alignments(make(rows, "doc_id"), make(items, "item_id")).collect()}
    want = brute_alignments(rows, items)
    assert want <= got and len(want) > 100
    # What is beyond the templates' own alignments stands word for word.
    words = lambda t: re.findall(r"\w+", t.lower())
    text, item = dict(rows), dict(items)
    runs = lambda w: {tuple(w[j : j + 8]) for j in range(len(w) - 7)}
    assert all(runs(words(text[i])) & runs(words(item[k])) for i, k in got - want)


# --- language-model scores


def test_losses_are_log_probabilities():
    r = np.random.default_rng(0)
    counts = r.integers(0, 3, lmscore.SYMBOLS**lmscore.ORDER)
    p = np.exp(-lmscore.losses(counts)).reshape(-1, lmscore.SYMBOLS).sum(axis=1)
    assert np.allclose(p, 1) and np.allclose(np.exp(-lmscore.losses(counts * 0)), 1 / lmscore.SYMBOLS)


@pytest.mark.parametrize("chunk", [1 << 25, 1])
def test_cross_entropy_equals_brute_force(spark, docs, none, monkeypatch, chunk):
    monkeypatch.setattr(lmscore, "CHUNK", chunk)
    rows = [(1, "abab zz abab"), (2, "ZZ9 é zz"), (3, ""), (4, None), (5, "abab q"), (6, "zz9 é zz"), (7, " \n")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in lmscore.cross_entropy_difference(frame, frame.where("doc_id IN (1, 5)")).collect()}
    own = {i: (t or "").lower().split() for i, t in rows}
    sides = ([1, 5], [2, 3, 4, 6, 7])
    tables = []
    for side in sides:
        counts = np.zeros(lmscore.SYMBOLS**lmscore.ORDER, np.int64)
        for w in (w for i in side for w in own[i]):
            np.add.at(counts, lmscore.codes(pa.array([f" {w} "]))[0][1:], 1)
        tables.append(lmscore.losses(counts))
    for i in own:
        if not own[i]:
            assert (got[i].n_tokens, got[i].target_loss, got[i].score) == (0, None, 0.0)
            continue
        want = []
        everywhere = [w for j in own if j != i for w in own[j]]
        for side, table in zip(sides, tables):
            others = [w for j in side if j != i for w in own[j]]
            loss = 0.0
            for w in own[i]:
                spelling = table[lmscore.codes(pa.array([f" {w} "]))[0][1:]].sum()
                corpus = 0.9 * everywhere.count(w) / len(everywhere) + 0.1 * np.exp(-spelling)
                loss += (spelling - np.log((others.count(w) + 1000 * corpus) / (len(others) + 1000))) / 2
            want.append(loss / len(own[i]))
        assert (got[i].target_loss, got[i].background_loss) == pytest.approx(want, rel=1e-4)
    # A text that occurs twice is known to the model that holds its other copy; capitals are folded.
    assert got[2].background_loss == pytest.approx(got[6].background_loss) and got[2].background_loss < got[1].background_loss
    if chunk > 1:
        assert lmscore.cross_entropy_difference(docs, docs.limit(1)).count() == len(ODD)
        assert lmscore.cross_entropy_difference(none, docs).count() == 0


def test_chunks_stand_apart_and_are_packed(spark):
    """A reader holds one chunk at a time, however many a task has written, and a word's place takes about as much as it says."""
    from tallymark.llm.common import Scratch

    text = "ab cd ef gh " * (lmscore.CHUNK // 12 + 1)
    frame = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string").coalesce(1)
    began = len(Scratch.live)
    got = lmscore.cross_entropy_difference(frame, frame.where("doc_id = 1")).select("doc_id", "n_tokens").collect()
    assert sorted(map(tuple, got)) == [(i, len(text) // 3) for i in (1, 2)]
    chunks = spark.read.parquet(Scratch.live[began].paths[0])
    held = chunks.selectExpr("input_file_name() AS f", "length(places) + length(words) AS n").collect()
    assert len(held) == len({r.f for r in held}) == 2 and max(r.n for r in held) < len(text) / 12
    Scratch.release(began)


def test_packed_words_and_places_come_back():
    places = np.array([0, 1, 255, 256, 70_000, 2**31 - 1, 0], np.int32)
    assert (lmscore.places_of(lmscore.packed_places(places)) == places).all() and len(lmscore.places_of(lmscore.packed_places(places[:0]))) == 0
    for words in ([], ["a"], ["é", "zz", "\u00a0"]):
        assert lmscore.words_of(lmscore.packed_words(pa.array(words, pa.string()))) == [w.encode() for w in words]


def test_shingles_follow_the_word_rule():
    a, b, c, d, e = shingles.shingle_hashes(pa.array(["A b\x0bc\td e", "a b c d e", "", None, "a\x85b c"]))
    assert (a == b).all() and len(a) == 1 and len(c) == len(d) == 0 and len(e) == 1


def test_pieces_seen_long_ago_are_not_encoded_again():
    from tallymark.llm import bpe

    c = bpe.Codec()
    words = [f"w{i}" for i in range(500_000)]
    for i in range(0, len(words), 50_000):
        c.encode(["a " + " ".join(words[i : i + 50_000])])
    kept = {**c.old, **c.young}
    assert all(w in kept for w in words)


def test_a_remembered_piece_takes_little_memory():
    import tracemalloc

    c, n = bpe.Codec(), 60_000
    text = "a " + " ".join(f"xq{i:06d}" for i in range(n))
    tracemalloc.start()
    c.encode([text])
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert len(c.young) == n and held < 200 * n  # 284 bytes a piece with lists of ids
