"""Merkle manifest, conversation repair and rule classifier against brute force, planted faults and held-out labels."""

import hashlib
import itertools
import os
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from conftest import SF01, SF001
from txrisk.llm import conversation_repair as repair
from txrisk.llm import merkle
from txrisk.llm import rule_ensemble as rules

DOCS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, RANK string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = (row[0], row[3], row[2], row[4], text)
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes):
    """Levels of a tree from its leaves to its root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def manifest(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each row, in plain Python."""
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append((r[0] is not None, r[0], leaf(r, r[1]), r))
    keys = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {k: climb([x[2] for x in sorted(by[k], key=lambda x: (x[0], x[1] or 0, x[2]))]) for k in keys}
    top = climb([trees[k][-1][0] for k in keys])
    out = []
    for s, k in enumerate(keys):
        for i, (known, doc_id, digest, r) in enumerate(sorted(by[k], key=lambda x: (x[0], x[1] or 0, x[2]))):
            text = r[1]
            if known and zlib.crc32(str(doc_id).encode()) % 5 == 0 and text is not None:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            fold, proof = leaf(r, text), []
            for levels, at in ((trees[k], i), (top, s)):
                for level in levels[:-1]:
                    lo = at // 16 * 16
                    proof += level[lo:at] + level[at + 1:lo + 16]
                    fold = h(*level[lo:at], fold, *level[at + 1:lo + 16])
                    at //= 16
            root = top[-1][0]
            out.append((doc_id, digest, trees[k][-1][0], root, h(*proof), fold, fold == root))
    return sorted(out, key=str)


def rows_of(n, seed, sources):
    rng = random.Random(seed)
    return [(rng.choice([i, i, i, None, 7]), rng.choice(["Some Text", "abc", None, "", "É" * i]), rng.choice(["en", None]),
             rng.choice(sources), rng.choice([None, i]), "old", "old") for i in range(n)]


@pytest.mark.parametrize("n, sources", [(1, [None]), (16, ["a"]), (17, ["a"]), (300, ["a", "a", "a", None, "b", ""]),
                                        (60, [f"s{i}" for i in range(40)]), (600, ["one"])])
def test_manifest_equals_plain_python(spark, n, sources):
    rows = rows_of(n, n, sources) + ([(5, "Twin", "en", sources[0], 4, "x", "y")] * 40 if n == 300 else [])
    got = merkle.audits(merkle.paths(merkle.build(spark.createDataFrame(rows, DOCS)))).collect()
    assert sorted((tuple(r) for r in got), key=str) == manifest(rows)


def test_manifest_of_an_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert merkle.audits(merkle.paths(merkle.build(empty))).collect() == []


def test_manifest_of_one_long_text(spark):
    rows = [(1, "Long Word " * 200_000, "en", "a", 2, "x", "y"), (2, "B", "en", "a", 1, "x", "y")]
    got = merkle.audits(merkle.paths(merkle.build(spark.createDataFrame(rows, DOCS)))).collect()
    assert sorted((tuple(r) for r in got), key=str) == manifest(rows)


def test_requests_descend_alone(spark):
    rows = [(i, f"Text {i}", "en", "ab"[i % 2], i, "x", "y") for i in range(500)]
    made = merkle.build(spark.createDataFrame(rows, DOCS))
    asked = made.leaves.where("doc_id in (3, 250, 499)")
    got = {r.doc_id: tuple(r) for r in merkle.audits(merkle.paths(made, asked)).collect()}
    want = {r[0]: r for r in manifest(rows)}
    assert got == {i: want[i] for i in (3, 250, 499)}
    # One record for each node: 250 leaves of a source are 16 + 1 nodes.
    assert [t.count() for t in made.records] == [2 * 16, 2 * 1]


def decode(rows):
    """Cheapest edits by a table of whole strings for every state, without pruning."""
    def inserted(best):
        changed = True
        while changed:
            changed = False
            for a, b in (("S", "u"), ("s", "u"), ("a", "u"), ("u", "a")):
                if a in best:
                    new = (best[a][0] + 3, best[a][1] + "I", best[a][2] + (({"u": "user", "a": "assistant"}[b], ""),))
                    if b not in best or new[:2] < best[b][:2]:
                        best[b], changed = new, True
        return best

    best = inserted({"S": (0, "", ())})
    for role, text, must_go, cut in rows:
        new = {}

        def offer(state, x):
            if state not in new or x[:2] < new[state][:2]:
                new[state] = x
        for state, (cost, audit, said) in best.items():
            offer(state, (cost + 4, audit + "D", said))
            for to, before in (("s", "S"), ("u", "Ssa"), ("a", "u")):
                if not must_go and state in before:
                    more = cost + 3 * cut
                    if role[:1] == to:
                        offer(to, (more, audit + "K", said + ((role, text),)))
                    if to != "s":
                        offer(to, (more + 3, audit + "R", said + (({"u": "user", "a": "assistant"}[to], text),)))
        best = inserted(new)
    return min(x for state, x in best.items() if state in "Sa")


def all_repairs(rows):
    """The least (cost, initials) over every sequence of edits; an empty role has an initial that fits nowhere."""
    steps = [[("D", "", 4)] + ([] if must_go else [("K", role[:1] or "?", 3 * cut), ("R", "u", 3 + 3 * cut), ("R", "a", 3 + 3 * cut)])
             for role, _, must_go, cut in rows]
    gaps = [("", ""), ("I", "u"), ("I", "a"), ("II", "ua"), ("II", "au")]
    best = None
    for edits in itertools.product(*steps):
        for put in itertools.product(gaps, repeat=len(rows) + 1):
            roles = put[0][1] + "".join(e[1] + p[1] for e, p in zip(edits, put[1:]))
            if re.fullmatch("(s?(ua)+)?", roles):
                audit = put[0][0] + "".join(e[0] + p[0] for e, p in zip(edits, put[1:]))
                found = (sum(e[2] for e in edits) + 3 * audit.count("I"), audit)
                best = found if best is None else min(best, found)
    return best


def decoded(rows):
    d, edits, most = repair.Decoder(), [], 0
    for role, text, must_go, cut in rows:
        edits += d.feed(role[:1], role, text, must_go, cut)
        most = max(most, d.unsettled)
    edits += d.finish()
    return (d.cost, "".join(e.letter for e in edits), tuple(e.message for e in edits if e.message)), most


def talk(rng, n):
    role = lambda: rng.choice(["user", "assistant", "user", "assistant", "system", "tool", ""])
    return [(role(), str(i), rng.random() < 0.2, rng.random() < 0.3) for i in range(n)]


def test_decoder_equals_all_sequences_of_edits():
    rng = random.Random(5)
    for _ in range(25):
        rows = talk(rng, rng.randint(0, 3))
        assert decoded(rows)[0][:2] == all_repairs(rows)


def test_decoder_equals_whole_tables():
    rng = random.Random(6)
    for _ in range(3000):
        rows = talk(rng, rng.randint(0, 25))
        assert decoded(rows)[0] == decode(rows)


def test_decoder_holds_only_what_is_undecided():
    rows = talk(random.Random(7), 20_000)
    (_, audit, _), most = decoded(rows)
    assert sum(c != "I" for c in audit) == 20_000 and most < 60


def test_ties_over_a_long_run():
    got, _ = decoded([("user", "x", False, False)] * 400)
    assert got == decode([("user", "x", False, False)] * 400)


TURNS = "conv_id long, turn long, role string, text string, lost string, edit string"


def plain_report(conv, turns):
    """The report of one conversation's rows (turn, role, text), damaged here in plain Python."""
    rows = []
    for turn, role, text in sorted(turns, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or " ", r[2] or " ")):
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, marked, faults = set(), [], [0, 0, 0]
    for turn, role, text in rows:
        body = re.findall(r"[^\x20\x09-\x0D]", text)
        flags = (not body, (role, text) in seen, bool(body) and body[-1] not in ".!?")
        seen.add((role, text))
        if any(flags):
            faults[flags.index(True)] += 1
        marked.append((role, text, flags[0] or flags[1], flags[2]))
    known = [r[0] for r in rows if r[0] is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, said = decode(marked)
    return (conv, gaps, *faults, illegal, cost, audit, h("\n".join(f"{a}:{b}" for a, b in said)))


def test_reports_of_edge_rows(spark):
    rng = random.Random(8)
    texts = ["Fine.", "Cut off", "", None, "  \n", "What? ", "Ä!\x0b", "z" * 30_000 + "."]
    rows = [(c, rng.choice([None, t, t, 3]), rng.choice(["user", "assistant", "system", None, "", "tool"]), rng.choice(texts))
            for c in [None, *range(30)] for t in range(rng.randint(1, 12))]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], TURNS)
    got = {r.conv_id: tuple(r) for r in repair.reports(repair.damaged(df)).collect()}
    assert got == {c: plain_report(c, [r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert repair.reports(repair.damaged(df.limit(0))).collect() == []


def test_reports_of_the_given_table(spark):
    turns = spark.read.parquet(f"{SF01}/conversations.parquet")
    by = {}
    for r in turns.collect():
        by.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    got = {r.conv_id: tuple(r) for r in repair.reports(repair.damaged(turns)).collect()}
    assert got == {c: plain_report(c, rows) for c, rows in by.items()}


def test_lost_conversations_have_a_row(spark):
    lost = [c for c in range(4000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    df = spark.createDataFrame([(c, 0, "user", "Hi.", "", "") for c in lost], TURNS)
    got = repair.reports(repair.damaged(df)).collect()
    assert sorted(tuple(r) for r in got) == [(c, 0, 0, 0, 0, 0, 0, "", h("")) for c in lost]


def test_repaired_conversations_read_as_they_should(spark):
    turns = spark.read.parquet(f"{SF001}/conversations.parquet")
    damaged = repair.damaged(turns).where("not lost").drop("lost")
    got = {}
    for r in sorted(repair.repaired(damaged).collect(), key=lambda r: (r.conv_id, r.place)):
        got.setdefault(r.conv_id, []).append(r)
    audits = {r.conv_id: r for r in repair.reports(damaged).collect()}
    assert set(got) == {c for c, r in audits.items() if r.audit}
    for c, edits in got.items():
        assert "".join(e.edit for e in edits) == audits[c].audit
        kept = [e for e in edits if e.role is not None]
        assert all((e.role is None) == (e.edit == "D") for e in edits)
        assert re.fullmatch("(s?(ua)+)?", "".join(e.role[0] for e in kept))
        assert h("\n".join(f"{e.role}:{e.text}" for e in kept)) == audits[c].repaired_sha256


TEXTS = ["", None, "word", "A b, c!\nA b, c!\n\nx\ty", "Ünï #1 | $$ 22 the the the", "one two three four five one two three four",
         " \n ", "HELLO!! World\n" * 50]


def plain_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = max(len(words), 1)
    chars = sum(map(len, words))
    count = lambda pattern: len(re.findall(pattern, text))
    windows = [tuple(words[i:i + 4]) for i in range(len(words) - 3)]
    lines = [x for x in text.split("\n") if x]
    return (chars / n, count("[A-Z]") / max(count("[A-Za-z]"), 1), count("[0-9]") / max(chars, 1),
            count(r"[#*$%&|<>]") / n, count("!") / n,
            sum(not re.search(r"[A-Za-z0-9\x80-\U0010FFFF]", w) for w in words) / n, len(set(words)) / n,
            sum(a == b for a, b in zip(words, words[1:])) / n, max(map(words.count, words), default=0) / n,
            (len(windows) - len(set(windows))) / max(len(windows), 1), (len(lines) - len(set(lines))) / max(len(lines), 1))


def test_statistics_equal_plain_python(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS * 2)], "id long, text string").coalesce(1)
    names = [c for c in rules.STATISTICS if c not in ("log_words", "marks")]
    order = ["word_length", "upper", "digits", "symbols", "exclaims", "bare", "distinct", "echoes", "top_word",
             "repeated_windows", "repeated_lines"]
    assert sorted(names) == sorted(order)
    for r in rules.statistics(df).collect():
        assert [r[c] for c in order] == pytest.approx(list(plain_statistics(r.text))), r.text


@pytest.fixture(scope="module")
def classified(spark):
    base = SF01
    docs = spark.read.parquet(f"{base}/documents.parquet")
    labels = spark.read.parquet(f"{base}/labels.parquet")
    model = rules.fit(rules.labelled(docs, labels))
    return docs, labels, model


def test_rules_tell_held_out_labels_apart(classified):
    docs, labels, model = classified
    rows = rules.scored(docs, model, keep=["doc_id"]).where("held_out").join(labels, "doc_id").collect()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert len(good) > 50 and len(bad) > 5
    above = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert above > 0.97
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95


def test_model_is_sparse_and_says_its_rules(classified):
    model = classified[2]
    assert 1 <= len(model.rules) <= 80 and len(model.texts()) == len(model.rules)
    assert any(len(c) > 1 for c, _ in model.rules)
    assert {n for c, _ in model.rules for n, _, _ in c} <= set(rules.STATISTICS)


def test_held_out_labels_do_not_matter(spark, classified):
    docs, labels, model = classified
    flipped = labels.withColumn("quality", F.when(rules.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = rules.fit(rules.labelled(docs.repartition(7), flipped.repartition(3)))
    assert other == model


def test_scores_equal_the_rules_in_plain_python(classified):
    docs, _, model = classified
    import math
    stats = {r.doc_id: r for r in rules.statistics(docs.select("doc_id", "text"), keep=["doc_id"]).collect()}
    for r in rules.scored(docs, model, keep=["doc_id"]).collect():
        z = model.intercept + sum(w for c, w in model.rules
                                  if all((stats[r.doc_id][n] > t) == up for n, up, t in c))
        assert r.score == pytest.approx(1 / (1 + math.exp(-z)))
        assert r.predicted == int(r.score >= 0.3) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_scores_of_edge_rows(spark, classified):
    model = classified[2]
    rows = [(1, None, "a"), (1, None, "a"), (None, "", "b"), (2, "x" * 3_000_000, None), (3, "a b " * 500_000, "c")]
    df = spark.createDataFrame([(*r, "old", "old") for r in rows], "doc_id long, text string, log_words string, SCORE string, document string")
    got = rules.scored(df, model).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert {r.document for r in got} == {"old"} and {r.log_words for r in got} == {"a", "b", "c", None}
    assert rules.scored(df.limit(0), model).collect() == []


def test_labels_of_one_kind_or_none(spark):
    docs = spark.createDataFrame([(i, "some words here") for i in range(40)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in rules.classified(docs, none).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1) for i in range(40)] + [(None, 0), (3, None)], "doc_id long, quality int")
    assert {r.predicted for r in rules.classified(docs, ones).collect()} == {1}


def test_sample_is_bounded(spark, classified):
    docs, labels, _ = classified
    few = rules.labelled(docs.union(docs), labels, sample=50)
    assert few.count() == 50 and os.path.exists(SF01)
