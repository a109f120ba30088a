"""Collocations, conversation repair and toxicity against plain versions of their definitions."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import collocations, conversation_repair, toxicity
from gaugeflow.llm.queries import damaged, op12_conversation_repair

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- 11: phrase collocations ------------------------------------------------------


def plain_collocations(rows, least, most):
    count = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    count[lang or "und"][tuple(words[i:i + size])] += 1
    result = []
    for lang, f in count.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for phrase, a in candidates.items():
            inside = any(
                len(other) > len(phrase) and 100 * b >= 80 * a
                and any(other[i:i + len(phrase)] == phrase for i in range(len(other)))
                for other, b in candidates.items()
            )
            if not inside:
                score, k = min(
                    (2_000_000 * a // (f[phrase[:k]] + f[phrase[k:]]), k) for k in range(1, len(phrase))
                )
                found.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        n = sum(c for p, c in f.items() if len(p) == 1)
        result += [
            (lang, rank, p.decode(), -a, left, right, n, -score)
            for rank, (score, a, p, left, right) in enumerate(sorted(found)[:most], 1)
        ]
    return sorted(result)


def found_collocations(docs, least, most=2000, shard_words=1 << 20):
    names = "lang rank phrase a l r n score".split()
    rows = collocations.collocations(docs, least, most, shard_words).collect()
    return sorted(tuple(r[n] for n in names) for r in rows)


def chatter(rng, n):
    words = ["the", "a", "New", "york", "city", "hall", "is", "Of", "été", "x\x01", "x", "e-mail"]
    return "".join(
        rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "! "])
        for _ in range(n)
    )


@pytest.mark.parametrize("shard_words", [1, 40, 1 << 20])
def test_collocations_equal_brute_force(spark, shard_words):
    rng = random.Random(shard_words)
    rows = [(rng.choice(["en", "fr", None]), chatter(rng, rng.randrange(60))) for _ in range(60)]
    rows += [("en", "New York city hall is")] * 12 + [("fr", None), ("fr", ""), ("de", "one two")]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    for least, most in ((3, 2000), (6, 2000), (4, 7)):
        assert found_collocations(docs, least, most, shard_words) == plain_collocations(rows, least, most)


def test_collocations_of_odd_rows(odd_docs, no_docs):
    rows = [(r["lang"], r["text"]) for r in odd_docs.collect()]
    assert found_collocations(odd_docs, 2) == plain_collocations(rows, 2, 2000)
    assert found_collocations(odd_docs, 10 ** 6) == []
    assert found_collocations(no_docs, 1) == []


def test_long_texts_are_split_between_pieces(monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 10)
    text = "Some words here, and then. " * 9 + "no break at all " * 9
    pieces = [w for s in collocations.stretches(text) for w in s.replace(b".", b" . ").split() if w != b"."]
    assert b" ".join(pieces).decode() == re.sub("[.,]", "", text).lower().strip()


def test_index_extends_both_ways():
    rng = np.random.default_rng(5)
    text = np.concatenate([[0], rng.integers(0, 5, 400), [0]]).astype(np.int32)
    forward, reverse = collocations.FmIndex(text, 4), collocations.FmIndex(text[::-1], 4)
    low, high = forward.words()
    after, before, start, counts, smaller = forward.extended(low, high)
    pairs = collections.Counter(
        (a, b) for a, b in itertools.pairwise(text.tolist()) if a and b
    )
    assert {(int(a), int(b) + 1): int(n) for a, b, n in zip(before, after, counts)} == pairs
    number, right, _, longer, _ = reverse.extended(low[after] + smaller, low[after] + smaller + counts)
    threes = collections.Counter(
        t for t in zip(text.tolist(), text[1:].tolist(), text[2:].tolist()) if all(t)
    )
    assert {
        (int(before[i]), int(after[i]) + 1, int(c)): int(n) for i, c, n in zip(number, right, longer)
    } == threes


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 9_007_199_254_740_993, 9_007_199_254_740_995, 2 ** 62
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(
        collocations._score(F.col("a"), F.col("l"), F.col("r")).alias("s")
    ).first()
    assert row["s"] == 2_000_000 * a // (left + right)


# -- 12: conversation repair ------------------------------------------------------


def plain_faults(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        if not bare:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return faults


def plain_repair(rows):
    """The least (cost, audit) by layers of all that is possible, without any heap."""
    faults = plain_faults(rows)

    def inserted(best):
        for _ in range(4):
            for state, (cost, audit) in list(best.items()):
                after = "a" if state == "u" else "u"
                option = (cost + 5, audit + "I")
                best[after] = min(best.get(after, option), option)
        return best

    best = inserted({"": (0, "")})
    for (_, role, _), fault in zip(rows, faults):
        new = {}

        def offer(state, option):
            new[state] = min(new.get(state, option), option)

        for state, (cost, audit) in best.items():
            offer(state, (cost + 2, audit + "D"))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault else 0
            for after in "sua":
                fits = state + after in ("su", "au", "ua") or (state == "" and after in "su")
                if fits and role[:1] == after:
                    offer(after, (cost + more, audit + "K"))
                elif fits and after != "s":
                    offer(after, (cost + 1 + more, audit + "R"))
        best = inserted(new)
    cost, audit = min(best[s] for s in ("", "a") if s in best)
    out, at, state = [], 0, ""
    for letter in audit:
        after = "assistant" if state == "u" else "user"
        if letter == "I":
            out.append(f"{after}:")
        else:
            _, role, text = rows[at]
            at += 1
            if letter == "D":
                continue
            after = role if letter == "K" else after
            out.append(f"{after}:{text}")
        state = after[0]
    return cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def plain_result(conv_id, rows):
    rows = sorted(rows, key=lambda r: (
        r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()
    ))
    faults = plain_faults(rows)
    turns = {r[0] for r in rows} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return (
        conv_id, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal,
        *plain_repair(rows),
    )


NAMES = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


def found_repairs(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=str)


def random_turns(rng, n):
    roles = ["user", "assistant", "system", "user", "assistant", "", "tool", "User", " "]
    texts = ["Hello there.", "And you?", "no end", "", " \n", "Yes!", "x", "É."]
    return [
        (rng.choice([None, rng.randrange(2 * n + 1), i]), rng.choice(roles),
         rng.choice(texts) if rng.random() < 0.5 else f"turn {i}{rng.choice(['.', '', '?'])}")
        for i in range(n)
    ]


def test_search_equals_plain_layers():
    rng = random.Random(12)
    for _ in range(400):
        rows = random_turns(rng, rng.randrange(1, 12))
        pairs = [(r[1][:1], f) for r, f in zip(rows, plain_faults(rows))]
        expected = plain_repair(rows)[:2]
        assert conversation_repair.search(pairs, 0, conversation_repair.GOALS) == expected
        # The same from blocks of any size.
        chain, at = conversation_repair.Chain(), 0
        while at < len(pairs):
            size = rng.randrange(1, 4)
            chain.add(conversation_repair.table_of(pairs[at:at + size]))
            at += size
        product = chain.product()
        assert min(product[0, g] for g in conversation_repair.GOALS if (0, g) in product) == expected


@pytest.mark.parametrize("block", [3, 256])
def test_repair_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(conversation_repair, "BLOCK_ROWS", block)
    rng = random.Random(block)
    sizes = [1, 2, 3, 5, 8, 200] + [rng.randrange(1, 9) for _ in range(50)]
    talks = {i: random_turns(rng, n) for i, n in enumerate(sizes)}
    talks[None] = random_turns(rng, 6)
    rows = [(c, *r, "extra", 1) for c, turns in talks.items() for r in turns]
    rng.shuffle(rows)
    df = spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string, digest string, block int"
    ).repartition(5)
    expected = sorted((plain_result(c, turns) for c, turns in talks.items()), key=str)
    assert found_repairs(conversation_repair.repair(df)) == expected


def test_repair_of_nothing_and_of_nulls(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert found_repairs(conversation_repair.repair(spark.createDataFrame([], schema))) == []
    df = spark.createDataFrame([(None, None, None, None), (1, None, None, "Hi."), (2, 0, "user", None)], schema)
    empty = hashlib.sha256(b"").hexdigest()
    assert found_repairs(conversation_repair.repair(df)) == sorted([
        (None, 0, 1, 0, 0, 0, 2, "D", empty), (1, 0, 0, 0, 0, 0, 2, "D", empty),
        (2, 0, 1, 0, 0, 0, 2, "D", empty),
    ], key=str)


def test_query_repairs_the_damage(spark):
    sf_dir = "/root/testdata/sf0.01"
    source = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    talks = collections.defaultdict(list)
    ids = set()
    for r in source.collect():
        conv_id, turn, role, text = r["conv_id"], r["turn"], r["role"] or " ", r["text"] or " "
        ids.add(conv_id)
        kind = zlib.crc32(f"{conv_id}:{turn}".encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        talks[conv_id] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    empty = hashlib.sha256(b"").hexdigest()
    expected = [
        plain_result(c, talks[c]) if talks[c] else (c, 0, 0, 0, 0, 0, 0, "", empty) for c in ids
    ]
    assert found_repairs(op12_conversation_repair(spark, sf_dir)) == sorted(expected, key=str)


def test_conversations_that_lose_all_rows_stay(spark, tmp_path):
    lost = next(i for i in range(10 ** 6) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    spark.createDataFrame(
        [(lost, 0, "user", "Hi.", "x"), (None, None, None, None, "y")],
        "conv_id long, turn long, role string, text string, copy string",
    ).write.parquet(f"{tmp_path}/conversations.parquet")
    assert damaged(spark.read.parquet(f"{tmp_path}/conversations.parquet")).filter(
        f"conv_id = {lost}"
    ).count() == 0
    found = {r[0]: r for r in found_repairs(op12_conversation_repair(spark, str(tmp_path)))}
    assert found[lost] == (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert set(found) == {lost, None}


# -- 13: toxicity -----------------------------------------------------------------


def labelled(spark, docs, n=600):
    rng = random.Random(13)
    words = [f"w{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    texts, labels, planted = [], [], {}
    for i in range(n):
        sentences = [" ".join(rng.choices(words, k=8)).capitalize() for _ in range(rng.randrange(1, 9))]
        toxic = i % 4 == 0
        if toxic:
            planted[i] = rng.randrange(len(sentences))
            sentences[planted[i]] += rng.choice([" you blasted fool", " foolish", " a blasted thing"])
        texts.append(". ".join(sentences) + ".")
        labels.append((i, int(toxic), None, "x"))
    table = spark.createDataFrame(labels, "doc_id long, toxic int, quality int, text string")
    return docs(texts), table, planted


def test_held_out_documents_and_their_sentences(spark, docs):
    table, labels, planted = labelled(spark, docs)
    found = toxicity.score(table, toxicity.learn(table, labels)).collect()
    held = [r for r in found if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(held) > 80
    assert all((r["score"] >= 0.5) == (r["doc_id"] in planted) for r in held)
    for r in held:
        spans = [r["text"][s["start"]:s["end"]].strip() for s in r["offending"]]
        if r["doc_id"] in planted:
            assert spans == [r["text"].split(". ")[planted[r["doc_id"]]].strip(". ")]
        else:
            assert spans == []


def test_held_out_labels_say_nothing(spark, docs):
    table, labels, _ = labelled(spark, docs, 200)
    flipped = labels.selectExpr(
        "doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 "
        "THEN 1 - toxic ELSE toxic END AS toxic"
    )
    assert np.array_equal(
        toxicity.learn(table, labels).weights, toxicity.learn(table, flipped).weights
    )


def test_length_alone_is_not_toxic(spark, docs):
    table, labels, _ = labelled(spark, docs)
    model = toxicity.learn(table, labels)
    long_ = "Waklm wbk whatever more. " * 5000
    assert toxicity.score(docs([long_]), model).first()["score"] < 0.5
    assert toxicity.score(docs([long_ + "Such a blasted fool."]), model).first()["score"] > 0.5


def test_toxicity_of_odd_rows(spark, docs, odd_docs, no_docs):
    table, labels, _ = labelled(spark, docs, 200)
    model = toxicity.learn(table, labels)
    found = toxicity.score(odd_docs, model)
    assert set(odd_docs.columns) - {"score"} <= set(found.columns)
    rows = found.collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["score"] == 0 for r in rows if not (r["text"] or "").strip())
    assert toxicity.score(no_docs, model).collect() == []
    odd_labels = spark.createDataFrame(
        [(None, 1), (0, None), (1, 1), (1, 0), *((i, 0) for i in range(2, 12))], "doc_id long, toxic int"
    )
    assert toxicity.learn(odd_docs, odd_labels).weights is not None
    for nothing in (labels.limit(0), labels.filter("toxic = 0")):
        assert {r["score"] for r in toxicity.score(table, toxicity.learn(table, nothing)).collect()} == {0.0}
    only = toxicity.learn(table, labels.filter("toxic = 1"))
    assert {r["score"] for r in toxicity.score(table, only).collect()} == {1.0}


def test_bound_of_the_sample(spark, docs):
    table, labels, _ = labelled(spark, docs, 300)
    again = table.unionByName(table)
    rows = toxicity.training_rows(again, labels.unionByName(labels), per_label=20).collect()
    assert collections.Counter(r["toxic"] for r in rows) == {True: 20, False: 20}
    assert toxicity.training_rows(table, labels, sample_chars=5).count() == 0
