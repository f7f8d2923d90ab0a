"""Piece encoding, spelling variants and collocations against the library or plain Python versions."""

import collections
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest

from sluice.llm import collocations, queries, sentencepieces, spelling
from sluice.llm.common import ready

SCHEMA = "doc_id long, text string, lang string, _text string, ids string, word string, n long, key string, chunk string, c long, phrase string"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def session(spark):
    ready(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    return spark


def odd_texts(rng):
    letters = "abcdeorst ▁   \n\t.,éè日本😀0123<>/&#xABC" + "".join(chr(rng.randrange(32, 0x3000)) for _ in range(40))
    texts = [None, "", " ", "  a", "\n", "▁a▁", "a\x00b", "日本語テキスト😀é", "<s>hi</s><unk>", "é", "﻿x", "x" * 50 + " " * 40 + "y", " " * 999, "a b " * 30_000]
    return texts + ["".join(rng.choice(letters) for _ in range(rng.randrange(70))) for _ in range(400)]


def frame(session, texts, langs=("en", "fr", None)):
    rows = [(i, t, langs[i % len(langs)], "x", "x", "x", 1, "x", "x", 1, "x") for i, t in enumerate(texts)]
    return session.createDataFrame(rows + [rows[2], (None, texts[3], *[None] * 9)], SCHEMA).repartition(3)


def test_encoding_is_the_library_s(session):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = frame(session, odd_texts(random.Random(3)))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    out = sentencepieces.encode(docs, MODEL, decoded=True)
    got = out.collect()
    assert out.columns == ["doc_id", "ids", "decoded"] and len(got) == docs.count()
    for r in got:
        ids = library.encode(texts[r["doc_id"]] or "")
        assert r["ids"] == ids and r["decoded"] == library.decode(ids), texts[r["doc_id"]]
    again = sentencepieces.decode(sentencepieces.encode(docs, MODEL), MODEL)
    assert all(r["text"] == library.decode(library.encode(texts[r["doc_id"]] or "")) for r in again.collect())


def test_decoding_of_ids_no_text_has(session):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    lists = [[259, 264, 13, 200, 3], [1, 264, 2], [230, 231], [0], [35, 264], [35], [], [2, 1], [1, 230, 264, 197]]
    got = sentencepieces.decode(session.createDataFrame(list(enumerate(lists)) + [(99, None)], "doc_id long, ids array<int>"), MODEL)
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {i: library.decode(x) for i, x in enumerate(lists)} | {99: ""}


def test_the_model_forgets_and_learns_again(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(sentencepieces, "CACHE_PARTS", 7)
    monkeypatch.setattr(sentencepieces, "CACHE_PAIRS", 3)
    small, texts = sentencepieces.PieceModel(MODEL), [f"the word{i} ends" for i in range(50)]
    monkeypatch.undo()
    large = sentencepieces.PieceModel(MODEL)
    for t in texts:
        assert small.encode(pa.array([t]))[0].tolist() == large.encode(pa.array([t]))[0].tolist()


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(counts, ratio=5):
    form, out = {}, {}
    for w, n in counts.items():
        close = [x for x in counts if near(w, x)]
        best = min(close, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
        out[w] = len(close)
    rows = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, n, out[w], form[w], None if form[w] is None else counts[form[w]], root))
    return sorted(rows, key=repr)


@pytest.mark.parametrize("alphabet, longest", [("ab", 7), ("abcé日", 9), ("a", 12)])
def test_variants_of_any_words(session, alphabet, longest):
    rng = random.Random(len(alphabet))
    words = {"".join(rng.choice(alphabet) for _ in range(rng.randrange(longest + 1))) for _ in range(300)}
    counts = {w: int(1.6 ** rng.randrange(20)) for w in words}
    df = session.createDataFrame([(w, n, "x", "y", 0) for w, n in counts.items()] + [(None, 3, "x", "y", 0)], "word string, n int, key string, near string, a int")
    got = spelling.group_variants(df.repartition(3))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == variants(counts)


def test_a_chain_of_forms_ends_at_its_root(session):
    chain = {"a" * (6 + i): 5 ** i for i in range(9)}
    got = spelling.group_variants(session.createDataFrame(list(chain.items()), "word string, n long"))
    assert {r["root"] for r in got.collect()} == {"a" * 14}


def test_slips_and_counts_of_words(session):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("abcdeÀéß") for _ in range(rng.randrange(5, 9))) for _ in range(30)]
    texts = [None, "", "Über", "x×y÷zabc"] + [" ".join(rng.choice(vocabulary) + rng.choice(["", ".", "日", "9"]) for _ in range(60)) for _ in range(60)]
    docs = frame(session, texts)
    want = collections.Counter()
    for r in docs.collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if r['doc_id'] is None else r['doc_id']}:{run}".encode())
            want[run if h % 7 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    runs = spelling.letter_runs(docs)
    got = spelling.counted(runs.select(spelling.with_slips(runs, 7).alias("word")), least=3)
    assert {r["word"]: r["n"] for r in got.collect()} == {w: n for w, n in want.items() if n >= 3 and len(w) >= 6}


def plain_collocations(rows, max_words, least, share, top):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            f.update((lang or "und", tuple(w[i:i + k])) for k in range(1, max_words + 1) for i in range(len(w) - k + 1))
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    covered = collections.Counter()
    for (lang, w), a in candidates.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                covered[lang, w[i:i + k]] = max(covered[lang, w[i:i + k]], a)
    out = collections.defaultdict(list)
    for (lang, w), a in candidates.items():
        cuts = [(f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
        left, right = min(cuts, key=lambda x: 1_000_000 * a * a // (x[0] * x[1]))
        if 100 * covered[lang, w] < share * a or (lang, w) not in covered:
            out[lang].append((-(1_000_000 * a * a // (left * right)), -a, " ".join(w).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
                  for lang, x in out.items() for i, (s, a, p, left, right) in enumerate(sorted(x)[:top]))


@pytest.mark.parametrize("max_words, every, longest", [(3, 16, 4096), (2, 3, 5), (4, 7, 9), (3, 1 << 40, 1 << 40)])
def test_collocations(session, monkeypatch, max_words, every, longest):
    rng = random.Random(max_words + every)
    words = ["a", "The", "the", "of", "é", "日本", "x9", "ab\x00c", "-"] + [f"w{i}" for i in range(30)]
    fixed = "one two Three four. five six"
    texts = [None, "", " .\n; ", "a", "a\tb", "same " * 5000, "."] + [
        "".join(rng.choice(words) + rng.choice([" ", " ", " ", " \t", ". ", ",", "\n", "!?"]) for _ in range(rng.randrange(120))) + rng.choice([fixed, ""])
        for _ in range(90)]
    docs = frame(session, texts)
    monkeypatch.setattr(collocations, "EVERY", every)
    monkeypatch.setattr(collocations, "LONGEST", longest)
    monkeypatch.setattr(collocations, "HELD_KEYS", 500)
    monkeypatch.setattr(collocations, "HELD_TEXTS", 300)
    got = collocations.collocations(docs, max_words=max_words, least=3, share=50, top=40)
    assert sorted(map(tuple, got.collect())) == plain_collocations([(r["lang"], r["text"]) for r in docs.collect()], max_words, 3, 50, 40)


@pytest.mark.parametrize("max_words, listed", [(3, 1 << 23), (4, 0)])
def test_words_that_share_a_hash_stay_apart(session, monkeypatch, max_words, listed):
    rng = random.Random(max_words)
    texts = [" ".join(rng.choice(["The", "the", "é", *(f"w{i}" for i in range(60))]) for _ in range(rng.randrange(99))) + rng.choice([" one two three.", ""])
             for _ in range(90)]
    docs = frame(session, texts)
    monkeypatch.setattr(collocations, "KEY_BITS", 5)
    monkeypatch.setattr(collocations, "LISTED_WORDS", listed)
    got = collocations.collocations(docs, max_words=max_words, least=3, share=50, top=40)
    assert sorted(map(tuple, got.collect())) == plain_collocations([(r["lang"], r["text"]) for r in docs.collect()], max_words, 3, 50, 40)


def test_a_task_hands_on_each_phrase_once(session, monkeypatch):
    rng = random.Random(9)
    docs = session.createDataFrame([("en", " ".join(rng.choice("abcdef") for _ in range(100))) for _ in range(400)], "lang string, text string").repartition(3)
    passes, plain = [], type(docs).mapInArrow

    def counting(df, fn, schema):
        rows = session.sparkContext.accumulator(0)
        passes.append((schema, df.rdd.getNumPartitions(), rows))

        def run(batches):
            for batch in fn(batches):
                rows.add(batch.num_rows)
                yield batch

        return plain(df, run, schema)

    monkeypatch.setattr(type(docs), "mapInArrow", counting)
    assert collocations.collocations(docs).count() > 0
    sums = [(tasks, rows.value) for schema, tasks, rows in passes if schema.endswith("n long") and "phrase string, key" not in schema]
    assert 0 < sum(n for _, n in sums) <= max(tasks for tasks, _ in sums) * (6 ** 2 + 6 ** 3)


def test_chunks_are_counted_once(session):
    text = " ".join(f"w{i % 97} x{i % 89}" for i in range(3000))
    one, many = (collocations.parse(session.createDataFrame([(text, "en")] * k, "text string, lang string"), "lang", "text", 3).collect() for k in (1, 9))
    assert {(r["chunk"], 9 * r["c"]) for r in one} == {(r["chunk"], r["c"]) for r in many} and len(one) > 50


def test_scores_of_large_counts_are_exact(session):
    big = 10 ** 14 + 7
    df = session.createDataFrame([(big, big + 3, big + 5)], "a long, l long, r long")
    got = df.selectExpr("cast(a as decimal(15, 0)) * cast(a as decimal(15, 0)) * cast(1000000 as decimal(7, 0))"
                        " div (cast(l as decimal(15, 0)) * cast(r as decimal(15, 0))) as s").first()["s"]
    assert got == 1_000_000 * big * big // ((big + 3) * (big + 5))


def test_empty_tables(session):
    docs = session.createDataFrame([], SCHEMA)
    assert sentencepieces.encode(docs, MODEL, decoded=True).collect() == [] and sentencepieces.decode(docs.selectExpr("doc_id", "array(1) as ids"), MODEL).collect() == []
    assert spelling.group_variants(spelling.counted(spelling.letter_runs(docs).withColumnRenamed("run", "word"))).collect() == []
    assert collocations.collocations(docs).collect() == []


@pytest.mark.parametrize("name", ["op12_spelling_variants", "op13_collocations"])
def test_queries_match_their_twins(session, small, name):
    import check

    status, note, _ = check.compare(session, check.connect(small), small, name, queries.QUERIES[name], queries.ORACLE[name])
    assert status == "ok", note


def test_encoding_query(session, small):
    import hashlib

    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r["doc_id"]: r["text"] for r in session.read.parquet(f"{small}/documents.parquet").collect()}
    got = queries.QUERIES["op11_sentencepiece"](session, small).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(np.array(ids).tolist()).encode()).hexdigest()
