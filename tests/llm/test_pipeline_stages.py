"""The pipeline's rows after each stage, held against plain Python over the stage's input."""

import hashlib
import itertools
import shutil

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SF001
from test_methods import sentences
from txrisk.llm import quality, substring_dedup
from txrisk.llm.common import fold_words

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PASSAGE = ("When the old mill closed the wheel was taken down and carried to the yard behind the school. "
           "Children climbed on it for many summers until the wood went soft. Nobody remembers who sold the iron rim. "
           "It may have gone to the smith in the next village. The stones are still there under the grass.")


def near(a, b):
    return len(a & b) / len(a | b) >= 0.8


def first_of_groups(texts):
    """Ids of the smallest document of each group linked by a Jaccard similarity of 0.8 over five-word shingles."""
    shingles = {}
    for i, t in texts.items():
        w = fold_words(t.encode())
        shingles[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in itertools.combinations(sorted(texts), 2):
        if near(shingles[a], shingles[b]):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i for i in texts if find(i) == i}


def repeated(texts):
    """Ids whose text holds a sentence of a repeated run that is not the run's first."""
    seen, out = set(), set()
    for i, text in sorted(texts.items()):
        units, runs = sentences(text), set()
        for x in range(len(units)):
            ahead = next((y for y in range(x + 1, len(units)) if sum(map(len, units[x:y + 1])) >= 20), None)
            back = next((y for y in range(x - 1, -1, -1) if sum(map(len, units[y:x + 1])) >= 20), None)
            runs |= {r for r in ((x, ahead), (back, x)) if None not in r}
        for x, y in sorted(runs):
            key = sum(units[x:y + 1], ())
            out |= {i} if key in seen else set()
            seen.add(key)
    return out


def leaking(texts, items):
    windows = set()
    for item in items:
        w = fold_words((item or "").encode())
        windows |= {tuple(w[k:k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(x) for x in windows}
    out = set()
    for i, t in texts.items():
        w = fold_words(t.encode())
        if any(tuple(w[k:k + n]) in windows for n in sizes for k in range(len(w) - n + 1)):
            out.add(i)
    return out


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """{doc_id: text} before the first and after each of four stages, the last stage's rows, and the benchmark.

    The given table with a passage planted in two clean documents, a copy of a third, and one short text.
    """
    folder = str(tmp_path_factory.mktemp("pipeline"))
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet")
    bench.write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    kept = {r.doc_id: r.text for r in quality.judged(docs).where("kept and lang = 'en' and length(text) > 1500").collect()}
    one, two, three = sorted(kept)[:3]
    planted = {one: kept[one] + "\n" + PASSAGE, two: PASSAGE + "\n" + kept[two]}
    rows = [(*r[:1], planted.get(r.doc_id, r.text), *r[2:]) for r in docs.collect()]
    rows += [(9001, kept[three], "en", "planted", len(kept[three])), (9002, "Too short.", "en", "planted", 10)]
    docs = spark.createDataFrame(rows, docs.schema)
    out = [{r[0]: r[1] for r in rows}]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{folder}/stage{k}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append({r.doc_id: r.text for r in docs.collect()} if k < 4 else docs.collect())
    yield out, [r.text for r in bench.collect()], (one, two, three)
    shutil.rmtree(folder)


def test_quality_rules_keep_whole_clean_documents(stages):
    (given, kept, *_), _, planted = stages
    assert {*planted, 9001} <= set(kept) and 9002 not in kept
    assert 0.7 * len(given) < len(kept) < len(given)
    assert all(given[i] == t for i, t in kept.items())


def test_near_duplicates_leave_the_first_of_each_group(stages):
    (_, before, after, *_), _, (one, two, three) = stages
    assert after == {i: before[i] for i in first_of_groups(before)}
    assert three in after and 9001 not in after and len(after) < len(before)


def test_repeated_passages_go_from_all_but_the_first(spark, stages):
    (_, _, before, after, *_), _, (one, two, _) = stages
    assert set(after) == set(before)
    changed = {i for i in after if after[i] != before[i]}
    assert changed == repeated(before) and two in changed and one not in changed
    assert PASSAGE in after[one] and "the wheel was taken down" not in after[two]
    own = spark.createDataFrame(sorted(before.items()), "doc_id long, text string")
    assert after == {r.doc_id: r.clean for r in substring_dedup.dedup(own).collect()}


def test_benchmark_passages_drop_their_documents(stages):
    (_, _, _, before, after, _), items, _ = stages
    gone = leaking(before, items)
    assert gone and after == {i: t for i, t in before.items() if i not in gone}


def test_the_last_stage_encodes_what_is_left(stages):
    (*_, texts, rows), _, _ = stages
    lib = Tokenizer.from_file(BYTES)
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        assert list(r.ids) == lib.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
