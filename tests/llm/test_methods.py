"""Operators against brute force, the libraries, or held-out accuracy."""

import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from txrisk.llm import (bpe, decontaminate, html_text, jaccard_join, language_model, licenses, quality, queries, substring_dedup,
                        token_counts)
from txrisk.llm.common import Words, fold_words, table

SF001 = "/root/testdata/sf0.001"
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in table(spark, SF001, "documents").collect()}


def fuzz(n, seed=1):
    r = random.Random(seed)
    parts = list("aabbeettts   \n\t▁'’éñ中あ😀\u0085\x1c\x00İß0123..!?<|") + [
        "<|endoftext|>", "  ", "'ll", "<s>", "<unk>", "<0x41>", "the", "ing", "ﬁ", "a" * 40]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 60))) for _ in range(n)] + \
        ["a" * 3000, " " * 700, "ab" * 900, "\n\n  \n", "".join(r.choice("etaoin") for _ in range(5000))]


def test_byte_bpe_equals_the_library(texts):
    own, lib = bpe.ByteBpe(BYTES, public_tokenizers.PATTERN), Tokenizer.from_file(BYTES)
    every = [*texts.values(), *fuzz(1500)]
    want = [e.ids for e in lib.encode_batch(every, add_special_tokens=False)]
    got = [own.encode(t) for t in every]
    assert got == want
    assert [own.decode(i) for i in got] == lib.decode_batch(want, skip_special_tokens=False)


def test_piece_counts_equal_the_library(texts):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    every = [*texts.values(), *fuzz(1500, 2)]
    assert token_counts.PieceCounter(PIECES).count(every) == [len(x) for x in lib.encode(every, num_threads=1)]


def test_quality_counts_by_definition(spark, texts):
    for r in quality.judged(table(spark, SF001, "documents"), keep=["doc_id"]).collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id])
        n = len(w)
        seen = Counter(tuple(w[j:j + 8]) for j in range(n - 7))
        cover = {k for j in range(n - 7) if seen[tuple(w[j:j + 8])] > 1 for k in range(j, j + 8)}
        lines, dup = set(), 0
        for x in texts[r.doc_id].split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", x):
                dup += x in lines
                lines.add(x)
        symbols = len(re.findall(r"[#*$%&|<>]", texts[r.doc_id]))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == \
            (n, sum(map(len, w)), symbols, dup, len(cover))
        assert r.base_failed == (n < 20 or 100 * len(cover) > 30 * n)


def test_distance_by_definition():
    p, q = np.array([[1.0, 3, 0]]), np.array([[2.0, 0, 2]])
    a, b = p[0] / 4, q[0] / 4
    m = (a + b) / 2
    want = sum(x * np.log2(x / y) / 2 for v in (a, b) for x, y in zip(v, m) if x)
    assert abs(quality.distance(p, q)[0] - want ** 0.5) < 1e-12


def test_verdicts_follow_the_labels(spark):
    d = "/root/testdata/sf0.01"
    got = quality.judged(table(spark, d, "documents"), keep=["doc_id"]).join(table(spark, d, "labels"), "doc_id")
    rows = [r for r in got.collect() if not r.base_failed]
    clean, junk = [[r.kept for r in rows if r.quality == q] for q in (1, 0)]
    assert np.mean(clean) >= 0.99 and np.mean(junk) <= 0.5


def test_clean_documents_stay_whatever_their_language_is_called(spark):
    d = "/root/testdata/sf0.01"
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    rows = docs.join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id").persist()
    refs = quality.references(docs)
    nameless = rows.withColumn("real", rows.lang).withColumn("lang", F.lit(None).cast("string"))
    got = [r for r in quality.judged(nameless, refs=refs).collect() if not r.base_failed]
    for lang in ("de", "en", "es", "fr"):
        assert np.mean([r.kept for r in got if r.real == lang and r.quality == 1]) >= 0.95, lang
    assert np.mean([r.kept for r in got if r.quality == 0]) <= 0.5
    # A fifth language has a reference of its own, and one of a few words is not judged by others'.
    for name, of in (("xx", docs), ("yy", docs.where("lang <> 'de'").union(rows.where("lang = 'de' and quality = 1").select("doc_id", "text", "lang").limit(3)))):
        mine = of.withColumn("lang", F.when(F.col("lang") == "de", name).otherwise(F.col("lang")))
        found = quality.judged(mine).where(F.col("lang") == name).join(table(spark, d, "labels"), "doc_id").collect()
        kept = [r.kept for r in found if r.quality == 1 and not r.base_failed]
        assert kept and np.mean(kept) >= 0.95
    # Without any language only the counting rules judge.
    bare = docs.limit(200).withColumn("lang", F.lit(None).cast("string"))
    assert all(r.kept != r.base_failed and r.word_distance is None for r in quality.judged(bare).collect())


def sentences(text):
    out = []
    for part in re.split(r"(?<=[.!?])[\x20\x09-\x0d]|\n", text):
        w = [x.decode() for x in fold_words(part.encode())]
        if w:
            h = Words([" ".join(w).encode()]).hash
            cut = [0] + [k for k in range(1, len(w)) if len(w) > 25 and int(h[k]) % 8 == 0] + [len(w)]
            out += [tuple(w[a:b]) for a, b in zip(cut, cut[1:])]
    return out


def test_substring_dedup_by_definition(spark, texts):
    got = {r.doc_id: r for r in substring_dedup.dedup(table(spark, SF001, "documents"), keep=["doc_id"]).collect()}
    seen = set()
    for i, text in sorted(texts.items()):
        units, runs = sentences(text), set()
        for x in range(len(units)):
            for y in range(x + 1, len(units)):
                if sum(map(len, units[x:y + 1])) >= 20:
                    runs.add((x, y))
                    break
            for y in range(x - 1, -1, -1):
                if sum(map(len, units[y:x + 1])) >= 20:
                    runs.add((y, x))
                    break
        gone = set()
        for x, y in sorted(runs):
            key = sum(units[x:y + 1], ())
            gone |= set(range(x, y + 1)) if key in seen else set()
            seen.add(key)
        assert got[i].removed == sorted(gone)
        assert (got[i].clean == text) == (not gone)


def test_planted_passage_is_removed(spark):
    r = random.Random(5)
    line = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    passage = ". ".join(line(9) for _ in range(6)) + "."
    rows = [(i, f"{line(30)}. {line(12)}.\n{passage}\n{line(30)}. {line(11)}.") for i in range(1, 6)]
    got = {r.doc_id: r.clean for r in substring_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [passage in got[i] for i in range(1, 6)] == [True, False, False, False, False]
    assert all(len(got[i].split()) == 83 for i in range(2, 6))


def test_passage_with_signs_strewn_in_is_removed(spark):
    r = random.Random(6)
    line = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    passage = ". ".join(line(12) for _ in range(5)) + "."
    signs = " ".join(w + r.choice(["***", "$$$", " %%%", "\"", ")"]) for w in passage.split())
    rows = [(1, f"{line(40)}.\n{passage}\n{line(30)}."), (2, f"{line(40)}.\n{signs}\n{line(30)}.")]
    got = {r.doc_id: r for r in substring_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].n_removed == 0 and got[2].n_removed > 0
    assert len(fold_words(got[2].clean.encode())) == 70


def test_every_long_shared_span_has_a_common_fingerprint():
    r = random.Random(3)
    for _ in range(50):
        span = [f"s{r.randint(0, 30)}" for _ in range(decontaminate.SPAN)]
        a, b = ([f"{x}{r.randint(0, 99)}" for _ in range(20)] for x in "ab")
        one, two = Words([" ".join(a + span + b).encode()]), Words([" ".join(b[:7] + span).encode()])
        prints = [set(decontaminate.selected(w, decontaminate.SPAN, decontaminate.KGRAM)[1].tolist()) for w in (one, two)]
        assert prints[0] & prints[1]


def test_jaccard_join_in_blocks_equals_whole_nodes(spark):
    docs = table(spark, SF001, "documents").select("doc_id", "text")
    # 60 near copies: one node of many classes
    base = " ".join(f"w{i}" for i in range(150)).split()
    near = spark.createDataFrame([(10_000 + i, " ".join(base[:2 * i + 20] + [f"new{i}"] + base[2 * i + 20:]))
                                  for i in range(60)], "doc_id long, text string")
    a, b = ({r.doc_id: (r.class_id, r.n_links) for r in
             jaccard_join.join_classes(docs.union(near), keep=["doc_id"], block=k).collect()} for k in (7, 512))
    assert a == b
    assert all(a[10_000 + i] == (10_000, 59) for i in range(60))


def test_prefix_is_as_long_as_recall_allows():
    d = jaccard_join.prefix_length(0.8, 0.9999)
    miss = lambda k: (1 - 0.8 ** k) ** jaccard_join.TREES
    assert miss(d) <= 1e-4 < miss(d + 1)


def test_tree_on_held_out_pages(spark):
    # The article of each page, cut out by its tags.
    tree = html_text.trained()
    for r in table(spark, SF001, "pages").collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        want = [" ".join(html_text.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert html_text.main_blocks(r.html, tree) == [x for x in want if x]


def test_wrapped_licenses_and_notices_are_found(spark):
    import textwrap
    story = " ".join(f"{STORY} Part {i}." for i in range(30))
    rows = [(i, label, story + "\n" + "\n".join(f"# {x}" for x in textwrap.wrap(t, 60)) + "\n" + story)
            for i, (label, t) in enumerate(licenses.TEMPLATES)]
    rows += [(100, "cc", f"{story}\nLicensed under CC BY-NC 4.0.\n"), (101, "proprietary", f"(c) A. All rights\nreserved. {story}"),
             (102, "", story), (103, "", ""), (104, "", None), (105, "", "cc by mail; the rights of all are reserved here")]
    docs = spark.createDataFrame(rows, "doc_id long, want string, text string")
    for r in licenses.scan(docs, passages=True).collect():
        assert set(r.want.split(",")) <= set(r.labels.split(",")) and (r.want != "" or r.labels == "" and r.score == 0), r.doc_id
    # Whatever a line meets, a passage meets.
    own = table(spark, SF001, "documents").select("doc_id", "text")
    lines = {r.doc_id: r for r in licenses.scan(own, keep=["doc_id"]).collect()}
    for r in licenses.scan(own, keep=["doc_id"], passages=True).collect():
        assert set(lines[r.doc_id].labels.split(",")) - {""} <= set(r.labels.split(","))
        assert (r.base_labels, r.n_base) == (lines[r.doc_id].base_labels, lines[r.doc_id].n_base)


STORY = "The river rose during the night and the people of the lower town carried what they could to the hill."


@pytest.mark.parametrize("page, want", [
    (f"<html><head><title>T</title><meta charset=utf-8><body><article><p>{STORY}</p></article></body></html>", [STORY]),
    (f"<head><title>T</title><script>if (a<b) x = '<div>';</script><article><p>{STORY}</p></article>", [STORY]),
    (f"<head><title>T</title><template><div>no</div></template></head><body><article>{STORY}</article>", [STORY]),
    (f"<head><title>T</title>{STORY}", [STORY]),
    (f"<body><div><button>Menu</div><article><p>{STORY}</p></article>", [STORY]),
    (f"<body><button>Menu<article><p>{STORY}</p></article><button>Top</button>", [STORY]),
    (f"<body><article><p><select><option>1<option>2</p><p>{STORY}</p></article>", [STORY]),
    (f"<body><article><div><object><param name=x></div><p>{STORY}</p></article>", [STORY]),
    (f"<article><p><button><div>Share</div></button></p><p>{STORY}</p></article>", [STORY]),
    (f"<article><p>{STORY}</p><p class='ad'>Buy {STORY}</p><p>{STORY}</p></article>", [STORY, STORY]),
    (f"<article><p class=ad>Buy<p>{STORY}</article>", [STORY]),
    (f"<article><p>{STORY}</p><ul><li class='comment'><p>I say</p><div>no</div><li>Yes.</ul></article>", [STORY, "Yes."]),
    (f"<article><table><tr><td id=sidebar>{STORY}<td>{STORY}<tr><td>{STORY}</table></article>", [STORY, STORY]),
])
def test_tags_without_end_and_names_of_paragraphs(page, want):
    assert html_text.main_blocks(page, html_text.trained()) == want


def test_language_model_knows_word_order(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").where("length(text) > 300")
    train, held = docs.where("doc_id % 5 <> 0"), docs.where("doc_id % 5 = 0").select("doc_id", "text")
    words = language_model.vocabulary(train)
    model = language_model.trained(train, words, rounds=2)
    r = random.Random(1)
    mixed = [(x.doc_id, " ".join(r.sample(w := x.text.split(), len(w)))) for x in held.collect()]
    real, wrong = ({x.doc_id: x.mean_log_probability for x in language_model.score(d, words=words, model=model).collect()}
                   for d in (held, spark.createDataFrame(mixed, "doc_id long, text string")))
    assert np.mean([real[i] > wrong[i] for i in real]) > 0.6
    assert np.mean(list(real.values())) > np.mean(list(wrong.values()))


def test_rare_words_have_their_own_probability(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").where("length(text) > 300").select("doc_id", "text")
    r = random.Random(2)
    junk = [(-i, " ".join("".join(r.choice("qxzjkvwpyfbg") for _ in range(8)) for _ in range(60))) for i in range(1, 21)]
    words = language_model.vocabulary(docs)
    model = language_model.trained(docs, words)
    clean, gibberish = ([x.mean_log_probability for x in language_model.score(d, words=words, model=model).collect()]
                        for d in (docs, spark.createDataFrame(junk, "doc_id long, text string")))
    assert max(gibberish) < min(np.mean(clean), np.median(clean)) - 5
    # The shares of all one- and two-byte words and of what begins longer ones are one; buckets follow the words.
    p = np.exp(words.spelling.log.astype(float)).reshape((language_model.SYMBOLS,) * 3)
    assert np.allclose(p.sum(-1), 1, atol=1e-4)
    few = language_model.vocabulary(docs.limit(50))
    assert 0 < few.buckets < words.buckets


def test_pipeline_equals_its_operators(spark):
    rows = corpus_pipeline.run(spark, SF001).collect()
    left = {r.doc_id for r in quality.judged(table(spark, SF001, "documents")).where("kept").collect()}
    assert {r.doc_id for r in rows} <= left and len(rows) == len({r.doc_id for r in rows}) > 0
    own = bpe.ByteBpe(BYTES, public_tokenizers.PATTERN)
    hits = {r.doc_id for r in decontaminate.leaks(table(spark, SF001, "documents"), table(spark, SF001, "benchmark"))
            .where("n_hit > 0").collect()}
    whole = {r.doc_id: r.text for r in table(spark, SF001, "documents").collect()}
    for r in rows:
        text = own.decode(r.ids)
        assert own.encode(text) == r.ids and r.n_tokens == len(r.ids)
        assert set(fold_words(text.encode())) <= set(fold_words(whole[r.doc_id].encode()))
    assert not hits & {r.doc_id for r in rows if own.decode(r.ids) == whole[r.doc_id]}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_equal_their_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    want = con.execute(queries.oracle_sql()[name])
    cols = [c[0] for c in want.description]
    got = queries.queries()[name](spark, SF001)
    assert sorted(got.columns) == sorted(cols)
    assert sorted(map(repr, (tuple(r) for r in got.select(*cols).collect()))) == sorted(map(repr, want.fetchall()))


def test_a_training_step_touches_only_what_its_words_meet():
    """One step equals Adagrad over all parameters to the bit, and its cost does not follow the number of buckets."""
    import time
    from txrisk.llm import language_model as lm
    rng = np.random.default_rng(3)
    ids = np.minimum(rng.zipf(1.3, 500), lm.VOCABULARY - 1).astype(np.int64)
    took = {}
    for buckets in (1_000, 1_000_000):
        near = rng.integers(0, lm.VOCABULARY + 1_000, (500, 2 * lm.REACH)).astype(np.int32)
        net = lm.Window(buckets=buckets)
        before, scale = net.rows.copy(), np.full_like(net.rows, 0.1)
        net.train(ids, near, scale)
        rest = np.setdiff1d(np.arange(net.seen), near)
        assert np.array_equal(net.rows[rest], before[rest]) and (scale[rest] == np.float32(0.1)).all()
        assert not np.array_equal(net.rows[np.unique(near)], before[np.unique(near)]) and not net.step.any()
        begun = time.process_time()
        for _ in range(20):
            net.train(ids, near, scale)
        took[buckets] = time.process_time() - begun
    assert took[1_000_000] < 8 * took[1_000]
    rows = rng.normal(size=(9, 3)).astype(np.float32)
    assert np.array_equal(lm.Window.sums(rows, np.array([0, 1, 4, 5])), np.add.reduceat(rows, [0, 1, 4, 5]))
