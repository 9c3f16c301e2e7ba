"""Every operator and stage on nulls, empty and long texts, repeated rows, empty tables and clashing names."""

import hashlib
import json

import public_tokenizers
import pytest

import corpus_pipeline
from txrisk.llm import (bpe, chat, decontaminate, html_text, jaccard_join, language_model, licenses, quality,
                        substring_dedup, token_counts)

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"word{i % 977}{'.' if i % 11 == 0 else ''}" for i in range(40_000))
ROWS = [(1, "The cat sat on the mat. It was the best of cats, and it sat.", "en"), (2, None, "en"), (None, "", None),
        (3, LONG, "xx"), (3, LONG, "xx"), (4, "   \n\t ", "de"), (5, "x" * 30_000, None), (None, "word", None)]
#: Extra columns named like the operators' own and helper columns.
CLASH = ["rid", "ord", "row", "doc", "document", "ids", "n_words", "N_TOKENS", "clean", "keys", "kept", "blocks"]
BENCH = "item_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    schema = "doc_id long, text string, lang string, " + ", ".join(f"{c} string" for c in CLASH)
    return spark.createDataFrame([r + tuple(f"old {c}" for c in CLASH) for r in ROWS], schema)


@pytest.fixture(scope="module")
def bench(spark):
    words = LONG.replace(".", "").split()
    return spark.createDataFrame([(7, " ".join(words[100:130])), (8, "Cat sat"), (None, "on the mat"), (9, None),
                                  (9, ""), (10, "x y")], BENCH)


def operators(bench):
    return {
        "decontaminate": lambda d: decontaminate.leaks(d, bench),
        "licenses": licenses.scan,
        "token_counts": lambda d: token_counts.with_limit(token_counts.count_tokens(d, PIECES)),
        "language_model": language_model.score,
        "jaccard_join": jaccard_join.join_classes,
        "bpe": lambda d: bpe.encode_and_decode(d, BYTES, public_tokenizers.PATTERN),
        "quality": quality.judged,
        "substring_dedup": substring_dedup.dedup,
    }


NAMES = ["decontaminate", "licenses", "token_counts", "language_model", "jaccard_join", "bpe", "quality",
         "substring_dedup"]


@pytest.mark.parametrize("name", NAMES)
def test_one_row_for_each_row_and_old_columns_stay(docs, bench, name):
    out = operators(bench)[name](docs)
    rows = out.collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in ROWS)
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    assert {c.lower() for c in docs.columns} <= {c.lower() for c in out.columns}


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(docs, bench, name):
    assert operators(bench)[name](docs.limit(0)).collect() == []


def test_leaks_of_edge_rows(docs, bench):
    got = {(r.doc_id, r.n_words): r for r in decontaminate.leaks(docs, bench).collect()}
    assert got[3, 40_000].items == ["7"] and got[3, 40_000].n_hit >= 30
    assert got[1, 15].items == ["8"] and got[1, 15].n_hit == 5 + 0 * 2  # "cat sat" and "on the mat"
    assert got[2, 0].n_hit == 0 and got[2, 0].items == []


def test_leaks_without_benchmark(spark, docs):
    none = spark.createDataFrame([], BENCH)
    assert {r.n_hit for r in decontaminate.leaks(docs, none).collect()} == {0}


def test_copies_share_a_class(docs):
    rows = jaccard_join.join_classes(docs).collect()
    twins = [r for r in rows if r.doc_id == 3]
    assert [r.n_links for r in twins] == [1, 1] and sum(r.is_first for r in twins) == 1
    assert all(r.n_links == 0 and r.is_first for r in rows if r.doc_id != 3)


def test_repeated_rows_lose_their_sentences_once(docs):
    rows = [r for r in substring_dedup.dedup(docs).collect() if r.doc_id == 3]
    assert sorted(r.clean == "" for r in rows) == [False, True]


def test_null_text_fails_the_rules_and_has_no_score(docs):
    r = next(r for r in quality.judged(docs).collect() if r.doc_id == 2)
    assert (r.n_words, r.base_failed, r.kept) == (0, True, False)
    r = next(r for r in language_model.score(docs).collect() if r.doc_id == 2)
    assert (r.n_words, r.log_likelihood, r.mean_log_probability) == (0, 0.0, None)


def test_pages(spark):
    rows = [(1, "<article><p>A &amp; b</p><p>c<br>d</p></article><footer>f</footer>"), (2, None), (3, ""),
            (4, "<article><p>cut <b off"), (5, "<script>var x = '<p>no</p>';"), (6, "<!-- <article><p>x</p>"),
            (7, "<article>" + "<p>long text here</p>" * 5000 + "</article>"), (7, "<nav>menu</nav>")]
    df = spark.createDataFrame([r + ("old", "old") for r in rows], "page_id long, html string, text string, n_chars string")
    got = html_text.extract(df).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got if r.page_id != 7}
    assert by[1].text == "A & b\n\nc d" and by[1].n_chars == 10
    assert [by[i].text for i in (2, 3, 5, 6)] == [""] * 4 and by[4].text.startswith("cut")
    assert sorted(r.n_chars for r in got if r.page_id == 7) == [0, 5000 * 14 + 4999 * 2]
    assert html_text.extract(df.limit(0)).collect() == []


def test_perspectives(spark):
    rows = [(1, 1, "ann", "hi"), (1, 2, "bob", "<|im_end|>"), (1, 0, "system", "be kind"), (1, 3, "cy", None),
            (2, 1, "system", "alone"), (None, 1, None, "a"), (None, 1, None, "a"), (3, None, "", "b" * 50_000)]
    df = spark.createDataFrame([r + ("x",) for r in rows], "conv_id long, turn long, role string, text string, name string")
    got = chat.perspectives(df).collect()
    one = [r for r in got if r.conv_id == 1]
    assert len(one) == 4 * 3 and {r.assistant for r in one} == {"ann", "bob", "cy"}
    for r in one:
        assert r.in_loss == (r.chat_role == "assistant") == (r.mask_to > r.mask_from)
        assert r.rendered.count("<|im_end|>") == 1
    bob = next(r for r in one if r.assistant == "bob" and r.in_loss)
    assert bob.rendered[bob.mask_from:bob.mask_to] == "< |im_end|><|im_end|>"
    ann = next(r for r in one if r.assistant == "bob" and r.name == "ann")
    assert ann.rendered == "<|im_start|>user name=ann\nhi<|im_end|>\n"
    assert not [r for r in got if r.conv_id == 2]
    assert [r.assistant for r in got if r.conv_id is None] == ["unknown", "unknown"]
    assert chat.perspectives(df.limit(0)).collect() == []


@pytest.mark.parametrize("k", range(5))
def test_stages(spark, docs, tmp_path, k):
    spark.createDataFrame([(1, "some other words")], BENCH).write.parquet(str(tmp_path / "benchmark.parquet"))
    stage = corpus_pipeline.STAGES[k][1]
    out = stage(spark, docs, str(tmp_path))
    if k < 4:
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    rows = out.collect()
    # No row has 20 words without repeats: the rules keep none.
    assert len(rows) == [0, 7, 8, 8, 8][k]
    if k == 4:
        assert all(r.n_tokens == len(r.ids) for r in rows)
    assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []


def test_digests_of_an_empty_text(docs):
    r = next(r for r in bpe.digests(bpe.encode_and_decode(docs, BYTES, public_tokenizers.PATTERN, keep=["doc_id"]))
             .collect() if r.doc_id == 2)
    empty = hashlib.sha256(b"").hexdigest()
    assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (0, empty, empty)


def test_tokenizer_files_are_read_by_path():
    assert json.load(open(BYTES, encoding="utf-8"))["model"]["type"] == "BPE"
