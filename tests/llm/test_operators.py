"""The text operators against plain Python versions on small hand-made tables, with the odd cases of each."""

import collections
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluice.llm import attribution, common, components, decontaminate, jaccard, licenses, linededup, packing, pii, quality, template, urlrules
from sluice.llm.common import ready

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, k string, label string"


@pytest.fixture(scope="module")
def session(spark):
    ready(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    return spark


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    base = [words(rng, rng.randrange(60, 160)) for _ in range(12)]
    near = [" ".join(w if rng.random() > 0.02 else "x" for w in base[0].split()) for _ in range(6)]
    passage = "\n".join(words(rng, 20) for _ in range(4))
    texts = base + near + [base[1], base[1], None, "", " \n\t", "one two", "One TWO", "a b c d", "long " * 9000]
    texts += [f"{words(rng, 60)}\n{passage}\n\n{words(rng, 60)}" for _ in range(3)] + [f"{passage}\nend", "é" * 50 + " ñandú <|endoftext|> ﬁ"]
    data = [(i, t, ["en", "fr", None][i % 3], "s" if i % 2 else None, i, -i, "k", "l") for i, t in enumerate(texts)]
    return data + [data[2], (None, base[3], None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(session, rows):
    return session.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(session):
    return session.createDataFrame([], SCHEMA)


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def shingle_set(t, k=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


@pytest.mark.parametrize("long_list", [2, 32])
def test_jaccard(docs, rows, long_list):
    sets = [shingle_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
            parent[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    want = sorted((repr(r[0]), len(sets[i]), repr(least.get(root(i)) if sets[i] else r[0])) for i, r in enumerate(rows))
    got = jaccard.near_duplicates(docs, long_list=long_list).collect()
    assert sorted((repr(r[0]), r[1], repr(r[2])) for r in got) == want


def test_jaccard_moves_only_what_long_lists_need(session, monkeypatch):
    """One list of 12 similar texts, and 100 texts that only lists of two hold: the components of the long list's groups are looked up, once a turn."""
    rng = random.Random(11)
    base = [f"b{i}" for i in range(60)]
    texts = [" ".join([*base, f"x{i}"]) for i in range(12)]
    for _ in range(50):
        own = [f"w{rng.randrange(10 ** 6)}" for _ in range(60)]
        texts += [" ".join(own), " ".join([*own, "end"])]
    docs = session.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = collections.defaultdict(list)

    def written(df, name, **options):
        out = common.written(df, name, **options)
        seen[name].append(out.count())
        return out

    monkeypatch.setattr(jaccard, "written", written)
    got = dict(jaccard.near_duplicates(docs, long_list=4).select("doc_id", "component_id").collect())
    assert got == {i: 0 if i < 12 else i - i % 2 for i in range(112)}
    assert 1 <= len(seen["marks"]) <= jaccard.PIVOT_ROUNDS + 1
    assert 0 < max(seen["marks"]) <= 12


@pytest.mark.parametrize("links", [[(i, i + 1) for i in range(40)], [(99, i) for i in range(40)], [(3, 3)], [],
                                   [(7 * i % 101, 7 * (i + 1) % 101) for i in range(0, 100, 3)] + [(5, 80), (80, 5)]])
def test_components(session, links):
    least = {x: x for link in links if link[0] != link[1] for x in link}
    for _ in links:
        for a, b in links:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    got = components.components(session.createDataFrame(links, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted(least.items())


def test_components_of_stars_need_no_round(session, monkeypatch):
    """Links that lead to the smallest node already, in either direction, are not dealt out again."""
    seen = []
    monkeypatch.setattr(components, "written", lambda df, name: (seen.append(name), common.written(df, name))[1])
    got = components.components(session.createDataFrame([(1, 2), (3, 1), (5, 4)], "a long, b long")).collect()
    assert sorted(map(tuple, got)) == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)]
    assert seen == ["links"]


def test_sketches_of_few_rows_are_small(session):
    docs = session.createDataFrame([(i, f"a b c d e{i} f g") for i in range(40)], "doc_id long, text string").repartition(4)
    chunks = jaccard.profile(docs, "doc_id", "text", 4).filter("chunk is not null").cache()
    assert chunks.agg(F.max(F.length("counts"))).first()[0] < 2000  # 64 KiB of counters, nearly all zero
    classes = jaccard.rarity_classes(chunks)
    assert sorted(set(classes.tolist())) == [0, 2, 11] and (classes == 11).sum() == 1  # none, once, 40 times


def test_bitmaps_grow_with_their_keys():
    assert [jaccard.bitmap_bits(n) for n in (0, 1000, 38_495, 10 ** 9)] == [1 << 18, 1 << 18, 1 << 20, common.BITMAP_BITS]


def deduped(rows, least=50):
    seen, out = {}, {}
    for doc_id, text in sorted({(r[0], r[1] or "") for r in rows}, key=lambda x: (x[0] is not None, x[0] or 0)):
        units = re.split(r"\n(?=[\x20\x09\x0B-\x0D]*[^\x20\x09-\x0D])", text)
        lines = [u.strip(" \t\n\x0b\f\r") for u in units]
        dead = set()
        for i in range(len(lines)):
            n = 0
            for j in range(i, len(lines)):
                n += len(lines[j].split())
                if n >= least and lines[i]:
                    run = tuple(lines[i:j + 1])
                    if seen.setdefault(run, (doc_id, text, i)) != (doc_id, text, i):
                        dead.update(range(i, j + 1))
        out[doc_id, text] = "\n".join(u for i, u in enumerate(units) if i not in dead)
    return out


def test_line_dedup(docs, rows):
    rows = [r for r in rows if r[0] is not None]
    want = deduped(rows)
    got = linededup.dedup_lines(docs.filter("doc_id is not null")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["text"] or "") == want[r["doc_id"], next(x[1] for x in rows if x[0] == r["doc_id"]) or ""]
    assert sum(r["n_removed"] for r in got) > 10 and all(r["text"] is not None or r["n_removed"] == 0 for r in got)


def test_decontamination(session, docs, rows):
    def tokens(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))

    leak = rows[4][1].split()
    items = [(1, " ".join(leak[5:25])), (2, "One, two!"), (3, None), (4, "..."), (5, " ".join(leak[30:39]) + " never"), (None, "a b c d"), (6, "a b c d"), (2, "One, two!")]
    windows = collections.defaultdict(set)
    for i, t in items:
        w = tokens(t)
        for s in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[s:s + 10])].add(i)
    want = []
    for r in rows:
        w, hit, found = tokens(r[1]), set(), set()
        for n in {len(x) for x in windows}:
            for s in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[s:s + n]))) is not None:
                    hit.update(range(s, s + n))
                    found |= own
        want.append((repr(r[0]), len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    got = decontaminate.contamination(docs, session.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((repr(r["id"]), r["n_words"], r["n_hit"], r["items"]) for r in got) == sorted(want)


def test_quality(docs, rows):
    got = quality.quality_report(docs).collect()
    assert len(got) == len(rows)
    by_id = {r[0]: r[1] for r in rows if r[0] is not None}
    for r in got:
        if r["doc_id"] is None:
            continue
        t = by_id[r["doc_id"]] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        c = collections.Counter(zip(w, w[1:], w[2:]))
        repeat = {j for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r["n_words"], r["word_chars"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(repeat))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(repeat) > 50 * len(w))
        assert not (r["base_failed"] and r["kept"])


def test_quality_thresholds_follow_the_group(session):
    rng = random.Random(1)
    data = [(i, words(rng, 200), "en", "a") for i in range(300)] + [(900, "##### " + " ".join(f"w{i}***" for i in range(200)), "en", "a")]
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_report(session.createDataFrame(data, "doc_id long, text string, lang string, source string")).collect()}
    assert not kept.pop(900) and all(kept.values())


def test_packing(docs, rows):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    got = packing.pack(docs, path, size=256).collect()
    want = collections.Counter()
    for r in rows:
        ids = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for p, s in enumerate(range(0, len(ids), 256)):
            want[r[0], p, s, len(ids[s:s + 256]), zlib.crc32(ids[s:s + 256].tobytes())] += 1
    assert collections.Counter(tuple(r)[:5] for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == list(np.cumsum([0] + [n for _, n in own])[:-1]) and sum(n for _, n in own) <= 256
    assert len(bins) <= -(-sum(r["length"] for r in got) // 256) + 2


def test_words_encoded_together():
    import public_tokenizers
    from tokenizers import Tokenizer

    class Counting:
        def __init__(self, tokenizer):
            self.tokenizer, self.texts = tokenizer, 0

        def encode_batch_fast(self, texts, **options):
            self.texts += len(texts)
            return self.tokenizer.encode_batch_fast(texts, **options)

    path = public_tokenizers.path("word_bpe_49k.json")
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz\u00e9\u00e8\u00ff"
    plain = [" ".join("".join(rng.choices(letters, k=rng.randint(1, 12))) for _ in range(300)) for _ in range(20)]
    odd = ["don't \u0130stanbul stra\u00dfe e\u0301t\u00e9 x\u00b2 \u00aa\u00f7\u00d7 3d", "", None, "<|endoftext|> \u00c9T\u00c9 ab12cd,ef", "\u1100\u1161 \u0100b\u0101"]
    encoder, whole = packing.Encoder(path), Tokenizer.from_file(path)
    encoder.tokenizer = counting = Counting(whole)
    ids, bounds = encoder.encode(pa.array(plain + odd))
    assert counting.texts < 200  # of some 6000 distinct words
    want = [e.ids for e in whole.encode_batch([t or "" for t in plain + odd], add_special_tokens=False)]
    assert [ids[bounds[i]:bounds[i + 1]].tolist() for i in range(len(want))] == want


def test_encoder_keeps_the_words_of_many_texts(monkeypatch):
    """Words that come again after 200,000 others are not encoded again."""
    encoder, learned = packing.Encoder(public_tokenizers.path("word_bpe_49k.json")), []
    monkeypatch.setattr(encoder, "_learn", lambda words, learn=encoder._learn: (learned.append(len(words)), learn(words)))
    letters = "abcdefghijklmnopqrstuvwxyz"
    several = ["".join(w) for w in itertools.islice(itertools.product(letters, repeat=4), 200_000)]
    texts = [pa.array([" ".join(several[i:i + 50_000])]) for i in range(0, 200_000, 50_000)]
    first = [encoder.encode(t)[0].tolist() for t in texts]
    assert [encoder.encode(t)[0].tolist() for t in texts] == first
    assert sum(learned) == 200_000


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(3)
    for _ in range(20):
        counts = rng.integers(0, 6, 101) * (rng.random(101) < 0.4)
        counts[0] = 0
        used = np.zeros(101, dtype=int)
        for pattern, copies in packing.plan(counts, 100):
            assert copies > 0 and sum(x * m for x, m in pattern.items()) <= 100
            for x, m in pattern.items():
                used[x] += m * copies
        assert (used == counts).all()


def test_attribution(docs, rows):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoding, _ = attribution._encoding(path, public_tokenizers.PATTERN)
    got = collections.defaultdict(list)
    for r in attribution.section_tokens(docs.filter("doc_id is not null and doc_id <> 2"), path, public_tokenizers.PATTERN).collect():
        got[r["doc_id"]].append(r)
    for r in rows:
        if r[0] in (None, 2):
            continue
        own = sorted(got[r[0]], key=lambda x: x["section"])
        assert sum(x["n_tokens"] for x in own) == len(encoding.encode_ordinary(r[1] or ""))
        assert "".join((r[1] or "")[x["start"]:x["end"]] for x in own) == (r[1] or "")


def test_crossing_tokens_go_to_the_larger_share():
    assert list(attribution.allocate(np.array([0, 2, 4, 5]), np.array([2, 4, 5, 9]), np.array([0, 3, 6]))) == [0, 0, 1, 2]


def test_surrogates(session):
    mail, phone = "ann.lee7@mail.example.com", "+1 (017) 555-7713"
    data = [(1, f"to {mail} or {phone}, 4952935900253052"), (2, f"TO {mail.upper()}!! call +10175557713"), (3, None), (4, "nothing 12 here"), (5, ""),
            (6, 'token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde" at 10.20.30.40.'), (7, "Frau Anna Weber and Mr. Lee, Frau Anna Weber"), (1, f"to {mail} or {phone}, 4952935900253052")]
    got = collections.defaultdict(list)
    for r in pii.pseudonymized(session.createDataFrame(data, "doc_id long, text string"), "key").collect():
        got[r["doc_id"]].append(r)
    assert got[1][0]["text"] == got[1][1]["text"] and mail not in got[1][0]["text"] and "5557713" not in re.sub(r"\D", "", got[1][0]["text"])
    new = re.search(r"\S+@\S+", got[1][0]["text"])[0]
    assert re.fullmatch(r"[a-z]{3}\.[a-z]{3}\d@mail\.example\.com", new) and new.upper() in got[2][0]["text"]
    digits = re.search(r"\+\d \(\d{3}\) \d{3}-\d{4}", got[1][0]["text"])[0]
    assert "+" + re.sub(r"\D", "", digits) in got[2][0]["text"]
    assert got[3][0]["text"] is None and got[4][0]["text"] == "nothing 12 here" and got[5][0]["text"] == ""
    assert re.fullmatch(r'token = "[0-9a-f]{40}" at (\d+\.){3}\d+\.', got[6][0]["text"]) and "2abc3ff2" not in got[6][0]["text"]
    a, _, b = re.fullmatch(r"Frau (\S+ \S+) and Mr\. (\S+), Frau (\S+ \S+)", got[7][0]["text"]).groups()
    assert a == b and a != "Anna Weber" and a.split()[0] in pii.NAMES["f latin"]


def test_surrogates_of_other_shapes(session):
    secrets = ["correcthorsebatterystaple", "abcdefghijklmnopqrst", "zyxwvutsrqponmlkjihg"]
    phones = ["(017) 555-7713", "+33 1 23 45 67 89", "+49 30 901820", "+44 20 7946 0958", "017-555-7713"]
    data = [f"PASSWORD={secrets[0]}", f"Token: {secrets[1]}", f'API_KEY="{secrets[2]}"', *[f"call {x}, now" for x in phones],
            "from 2001:db8::8a2e:370:7334 on", "from fe::ab on", "from ABCD:EF:a:b:c:d:e:f on", "mail ann@mail.example.com", "Dr and Frau Weber; later Weber and Webers",
            "Mr. Jim Poe came. Jim Poe left.", "at 12:30:45 std::sort took a: b"]
    got = {r["doc_id"]: r for r in pii.pseudonymized(session.createDataFrame(list(enumerate(data)), "doc_id long, text string"), "key").collect()}
    kinds = ["secret"] * 3 + ["phone"] * 5 + ["ip"] * 3 + ["email"]
    lost = [*secrets, *phones, "2001:db8::8a2e:370:7334", "fe::ab", "ABCD:EF:a:b:c:d:e:f", "ann@mail"]
    for i, (kind, x) in enumerate(zip(kinds, lost)):
        assert x not in got[i]["text"] and {k: got[i][f"n_{k}"] for k in pii.KINDS} == {k: int(k == kind) for k in pii.KINDS}, (x, got[i])
    for i, x in enumerate(phones):
        assert re.sub(r"\d", "0", got[3 + i]["text"]) == re.sub(r"\d", "0", data[3 + i])
    a, b = re.fullmatch(r"Dr and Frau (\S+); later (\S+) and Webers", got[12]["text"]).groups()
    assert a == b != "Weber" and got[12]["n_person"] == 2
    a, b = re.fullmatch(r"Mr\. (\S+ \S+) came\. (\S+ \S+) left\.", got[13]["text"]).groups()
    assert a == b != "Jim Poe"
    assert got[14]["text"] == data[14]


def test_surrogates_stay_distinct(session):
    entities = session.createDataFrame([("email", f"{c}@x.yz") for c in "abcdefghijklmnopqrstuvwxyz"], "kind string, norm string")
    got = pii.surrogates(entities, "key").collect()
    assert len({r["surrogate"] for r in got}) == 26 and not {r["surrogate"] for r in got} & {r["norm"] for r in got}


def test_licenses(session):
    rng = random.Random(2)
    mit = licenses.TEMPLATES["mit"].split()
    data = [(1, f"{words(rng, 80)} {' '.join(mit)} {words(rng, 90)}"), (2, "Released under the MIT License."), (3, None), (4, "of the MIT"),
            (5, words(rng, 30) + " " + " ".join(w if i != 9 else "zzz" for i, w in enumerate(mit))), (6, ""), (6, "")]
    got = collections.Counter((r["doc_id"], r["licenses"]) for r in licenses.license_report(session.createDataFrame(data, "doc_id long, text string")).collect())
    assert got == {(1, "mit"): 1, (2, "mit line"): 1, (3, ""): 1, (4, ""): 1, (5, "mit"): 1, (6, ""): 2}


def test_urls(session):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("b.example.org", "/", "block"), ("b.example.org", "/es", "allow"), (None, "/", "block")]
    urls = ["http://A.Example.org/es/1?x", "https://b.example.org/es/", "http://b.example.org/x#y", "http://badexample.org/es/", "http://x.com/", "nourl", None, "http://org", "x://org/"] * 3
    got = urlrules.judge(session.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, rule string"),
                         session.createDataFrame(rules, "host string, path string, verdict string")).collect()
    assert len(got) == len(urls)
    for r in got:
        fits = [(len(h + p), h + p, v) for h, p, v in rules if h and (r["host"] == h or r["host"].endswith("." + h)) and r["path"].startswith(p)]
        want = max(fits) if fits else (0, None, "allow")
        assert (r["rule"], r["verdict"]) == want[1:]


def test_pages(session):
    page = ("<html><head><title>x</title></head><body><header>H</header><nav><ul><li>a<li>b</ul></nav><div class='ad'>buy</div><article><h1>T &amp; x</h1>"
            "<p>One <b>two<br><p>three\n four</p><div class=\"comments\"><p>nice</p></div><form>q</form><aside>s</aside><script>var t='</p>';</script></article></body>")
    bare = "<body><p>Menu of the site</p><p>Own words {}</p></body>"
    data = [(1, "http://a.b/1", page), (2, None, None), (3, "http://a.b/3", ""), (1, "http://a.b/1", page)] + [(10 + i, "http://c.d/x", bare.format(i)) for i in range(6)]
    got = sorted((r["page_id"], r["text"], r["n_chars"]) for r in template.extract(session.createDataFrame(data, "page_id long, url string, html string")).collect())
    text = "T & x\nOne two\nthree four"
    assert got[:4] == [(1, text, len(text))] * 2 + [(2, "", 0), (3, "", 0)]
    assert [t for _, t, _ in got[4:]] == [f"Own words {i}" for i in range(6)]


def extracted(session, data):
    """{page_id: set of texts}"""
    got = collections.defaultdict(set)
    for r in template.extract(session.createDataFrame(data, "page_id long, url string, html string")).collect():
        got[r["page_id"]].add(r["text"])
    return got


def test_template_texts_in_articles(session):
    rng = random.Random(3)
    own = [[words(rng, 12) for _ in range(3)] for _ in range(8)]
    page = "<body><div class='ad'>{}</div><article><h1>{}</h1><p>{}</p><p>{}</p><div>Tell your friends</div></article></body>"
    data = [(i, f"http://a.b/{i}", page.format(i, *x)) for i, x in enumerate(own)]
    data += [(20 + i, f"http://c.d/{i}", page.format(i, *own[0])) for i in range(9)]  # copies among different adverts
    edited = "<body><main><h1>{}</h1><p>{}</p><p>{}</p><p>{}</p></main></body>"
    data += [(40 + i, f"http://e.f/{i}", edited.format(*own[1], f"Edited {i}")) for i in range(9)]
    got = extracted(session, data)
    assert all(got[i] == {"\n".join(x)} for i, x in enumerate(own))
    assert all(got[20 + i] == {"\n".join([*own[0], "Tell your friends"])} for i in range(9))
    assert all(got[40 + i] == {"\n".join([*own[1], f"Edited {i}"])} for i in range(9))


def test_copies_of_pages_without_article(session):
    rng = random.Random(4)
    bare = "<body><p>Menu of the site</p><p>{}</p></body>"
    table = "<body><p>Menu of the site</p><p>Prices</p><table><tr><td>tea</td><td>12</td></tr></table></body>"
    data = [(1, "http://a.b/x", table)] * 4 + [(2 + i, f"http://a.b/{i}", table) for i in range(8)]  # a host of copies only
    data += [(20 + i, f"http://c.d/{i}", table) for i in range(8)] + [(30 + i, f"http://c.d/o{i}", bare.format(words(rng, 9))) for i in range(5)]
    few = [words(rng, 9) for _ in range(3)]
    data += [(40 + i, f"http://e.f/{i}", bare.format(x)) for i, x in enumerate(few)]
    long = [words(rng, 9) for _ in range(6)]
    data += [(50 + i, f"http://g.h/{i}", f"<body><div>{'</div><div>'.join(long)}</div><div>Edited {i}</div></body>") for i in range(3)]
    data += [(60, "http://i.j/", bare.format("One page"))]
    got = extracted(session, data)
    assert all(got[i] == {"Menu of the site\nPrices\ntea\n12"} for i in range(1, 10))
    assert all(got[20 + i] == {"Prices\ntea\n12"} for i in range(8)) and all("Menu" not in x for i in range(5) for x in got[30 + i])
    assert all(got[40 + i] == {x} for i, x in enumerate(few))
    assert all(got[50 + i] == {"\n".join([*long, f"Edited {i}"])} for i in range(3))
    assert got[60] == {"Menu of the site\nOne page"}


def test_empty_tables(session, empty):
    path, ranks = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    items = empty.select("doc_id", "text").withColumnRenamed("doc_id", "item_id")
    pages = session.createDataFrame([], "page_id long, url string, html string")
    rules = session.createDataFrame([], "host string, path string, verdict string")
    for df in (jaccard.near_duplicates(empty), linededup.dedup_lines(empty), decontaminate.contamination(empty, items), quality.quality_report(empty),
               packing.pack(empty, path), attribution.section_tokens(empty, ranks, public_tokenizers.PATTERN), pii.pseudonymized(empty, "k"),
               licenses.license_report(empty), urlrules.judge(pages, rules), template.extract(pages)):
        assert df.collect() == []


def test_pipeline(session, small):
    """Every stage keeps columns; no later stage sees a row that an earlier one dropped."""
    import corpus_pipeline

    docs = session.read.parquet(f"{small}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(session, docs, small).cache()
        assert docs.count() <= before or name == "best_fit_packing"
        if name != "best_fit_packing":
            assert docs.columns == columns
            before, kept = docs.count(), {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert {r["doc_id"] for r in docs.select("doc_id").collect()} == kept


def test_pipeline_near_duplicates(session):
    """The stage against all pairs of five-word sets at 0.8."""
    import corpus_pipeline

    rng = random.Random(8)
    texts = []
    for cut in (8, 13, 17, 19, 20, 21, 22, 23, 24, 25, 31):  # one copy of each, so that no other copy links them
        base = [f"v{rng.randrange(10 ** 6)}" for _ in range(120)]
        texts += [" ".join(base), " ".join(base[:-cut] + [f"u{rng.randrange(10 ** 6)}" for _ in range(rng.choice([0, 3]))])]
    data = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    sets = [shingle_set(t, 5) for t in texts]
    root = list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both) and root[i] != root[j]:
            low, high = sorted((root[i], root[j]))
            root = [low if x == high else x for x in root]
    got = corpus_pipeline.near_duplicates(session, session.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long"), "")
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(set(root))


CLASHES = ["_id", "_k", "_s", "_t", "_n", "_lang", "_source", "_words", "_lines", "_units", "_dead", "_rest", "_others", "_symbols_high", "n_words", "n_lines",
           "n_removed", "n_email", "kept", "base_failed", "id", "k", "dead", "component_id", "word_chars", "n_hit", "items"]


def test_names_of_further_columns_do_not_matter(session, docs, small):
    """Every operator that keeps columns, and every stage, with columns named like their own."""
    import corpus_pipeline

    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    clashing = plain.select("*", *[F.concat(F.lit(f"{c} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in CLASHES])
    items = session.createDataFrame([(1, "w1 w2 w3")], "item_id long, text string")

    def same(apply):
        want, got = apply(plain), apply(clashing)
        assert got.columns[:len(clashing.columns)] == clashing.columns
        assert collections.Counter(map(repr, want.select(plain.columns).collect())) == collections.Counter(map(repr, got.select(plain.columns).collect()))
        for r in got.collect():
            assert all(r[c] == f"{c} {'none' if r['doc_id'] is None else r['doc_id']}" for c in CLASHES)
        return want, got

    same(quality.quality_filter)
    same(lambda d: decontaminate.decontaminated(d, items))
    want, got = same(linededup.dedup_lines)
    assert got.columns[-2:] == ["n_lines_", "n_removed_"] and want.columns[-2:] == ["n_lines", "n_removed"]
    same(lambda d: pii.pseudonymized(d, "secret"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        same(lambda d: stage(session, d, small))
    assert corpus_pipeline.STAGES[-1][1](session, clashing, small).count() == corpus_pipeline.STAGES[-1][1](session, plain, small).count()
