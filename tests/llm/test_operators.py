"""Each operator against brute force on small tables with every odd case."""

import collections
import hashlib
import math
import random
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from gridstone.llm import decontaminate, encoding, license_scan, near_join, packing, pii, quality, sharding, substring_dedup, textcore, token_counts, weighted_sampling

from ..conftest import rows

public_tokenizers = pytest.importorskip("public_tokenizers")
BPE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, p string, part int, n_words long, k long, s long, size long"
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(UPPER))


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def make_texts(seed=1):
    """Nulls, empties, copies, near copies, shared passages and long texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "Straße", "a", "the", "漢字"]
    body = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage = body(30)
    base = [body(n) for n in (120, 60, 200, 25)]
    texts = [None, "", " \n\t ", "one", "two words", body(19), body(20), base[0], base[0], base[1], base[1] + " tail", base[2].replace("w1 ", "W1, "), base[2]]
    texts += [f"{body(15)} {passage} {body(9)}" for _ in range(5)] + [passage, passage + " " + passage, "x " * 70, body(3000), "same " * 3000, base[3].upper(), base[3]]
    near = base[2].split()
    for i in range(12):
        copy = list(near)
        copy[rng.randrange(len(copy))] = f"edit{i}"
        texts.append(" ".join(copy))
    return texts


@pytest.fixture(scope="module")
def texts():
    return make_texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    """Ids in shuffled order; clashing extra columns, null ones too."""
    ids = list(range(len(texts)))
    random.Random(2).shuffle(ids)
    data = [(i, t, None, None, None, None, None, 1, None) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(data, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def pairs(docs):
    return sorted((r["doc_id"], r["text"]) for r in docs.collect())


@pytest.fixture(scope="module")
def odd(spark):
    """A null key and a row that occurs twice."""
    text = " ".join(f"q{i}" for i in range(40))
    row = lambda i, t: (i, t, "en", "p", 1, 1, 1, 1, 1)
    return spark.createDataFrame([row(None, text), row(None, None), row(5, text), row(5, text), row(6, text), row(7, None)], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_word_splitting_and_hashes(texts):
    for table, split in ((textcore.SPACED, lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")), (textcore.PLAIN, words)):
        got, hashes = [], {}
        for x, y, s in textcore.slices(pa.array(texts), table, 300):
            h = s.hashes
            for i in range(y - x):
                own = s.words(s.first[i], s.first[i + 1])
                got.append([w.decode() for w in own])
                for w, v in zip(own, h[s.first[i] : s.first[i + 1]], strict=True):
                    assert hashes.setdefault(w, v) == v
        assert got == [split(t) for t in texts]
        assert len(set(hashes.values())) == len(hashes)


def brute_repeats(pairs, length):
    seen, out = set(), {}
    for i, t in pairs:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            gram = tuple(w[k : k + length])
            if gram in seen:
                gone[k : k + length] = [True] * length
            seen.add(gram)
        out[i] = (len(w), sum(gone), " ".join(a for a, g in zip(w, gone, strict=True) if not g))
    return out


@pytest.mark.parametrize("length", [20, 7])
def test_substring_dedup(docs, pairs, length, monkeypatch):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in substring_dedup.remove_repeats(docs, length).collect()}
    assert got == brute_repeats(pairs, length)
    assert sum(x[1] for x in got.values()) > 100


@pytest.mark.parametrize("group", [1, 3])
def test_substring_dedup_lengthens_frequent_prefixes(docs, pairs, group, monkeypatch):
    monkeypatch.setattr(substring_dedup, "GROUP", group)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in substring_dedup.remove_repeats(docs).collect()}
    assert got == brute_repeats(pairs, 20)


def test_tree_names_are_nodes_in_order():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 3, 400).astype(np.uint64)
    for length in (1, 2, 5, 6, 8, 20):
        starts = rng.integers(0, 400 - length + 1, 300)
        strings = [tuple(words[s : s + length].tolist()) for s in starts]
        rank = {s: i for i, s in enumerate(sorted(set(strings)))}
        assert substring_dedup.tree_names(words, starts, length).tolist() == [rank[s] for s in strings]


def test_substring_dedup_takes_any_ordered_key(spark, docs, pairs):
    named = docs.withColumn("doc_id", F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 9, "0")))
    got = {int(r["doc_id"][1:]): (r["n_words"], r["n_removed"], r["kept_text"]) for r in substring_dedup.remove_repeats(named).collect()}
    assert got == brute_repeats(pairs, 20)


def test_substring_dedup_odd_cases(odd, empty):
    got = sorted(((r["doc_id"], r["n_removed"], r["kept_text"] != "") for r in substring_dedup.remove_repeats(odd).collect()), key=str)
    assert got == sorted([(None, 0, True), (None, 0, False), (5, 0, True), (5, 0, True), (6, 40, False), (7, 0, False)], key=str)
    assert substring_dedup.remove_repeats(empty).count() == 0


def jaccard(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_fingerprints(docs, pairs):
    got = {r["doc_id"]: r for r in weighted_sampling.fingerprint_documents(docs, samples=64).collect()}
    order = sorted(pairs, key=lambda x: x[0], reverse=True)
    bag = lambda t: collections.Counter(t.lower().split())
    errors = []
    for n, (i, t) in enumerate(order):
        t, nxt = t or "", order[(n + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        assert (got[i]["n_chars"], got[i]["edited_sha256"]) == (len(t), sha(edited))
        if t.strip() and nxt.strip():
            errors += [got[i]["near_edited"] - jaccard(bag(t), bag(edited)), got[i]["near_next"] - jaccard(bag(t), bag(nxt))]
    assert abs(np.mean(errors)) < 0.03 and np.sqrt(np.mean(np.square(errors))) < 0.08
    prints = collections.defaultdict(set)
    for i, t in pairs:
        prints[t or ""].add(got[i]["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())


def test_fingerprint_odd_cases(odd, empty, spark):
    assert [r[0] for r in rows(weighted_sampling.fingerprint_documents(odd), "doc_id")] == [5, 5, 6, 7]
    assert weighted_sampling.fingerprint_documents(empty).count() == 0
    alone = weighted_sampling.fingerprint_documents(odd.where("doc_id = 6")).first()
    assert alone["near_next"] == 1.0
    with pytest.raises(ValueError):
        weighted_sampling.fingerprint_documents(odd, samples=3)


def plain_print(text, samples):
    """Each sample by its definition, no table and no sharing."""
    known = lambda x, seed: xxhash.xxh64(x, seed=seed).intdigest()
    gamma, best = weighted_sampling._gamma_quantiles(), [(float("inf"), 0)] * samples
    for word, n in (collections.Counter(w for w in re.split("[ \t\n\r\x0b\x0c]+", text.lower()) if w) or {None: 1}).items():
        word = 42 if word is None else known(word.encode(), 42)
        for j in range(samples):
            h = known(struct.pack("<i", j), known(struct.pack("<Q", word), 42))
            r, b, p = gamma[h & 1023], (h >> 10 & (1 << 22) - 1) / (1 << 22), ((h >> 32) + 0.5) / (1 << 32)
            t = math.floor(math.log(n) / r + b)
            ln_a = math.log(p) / 2 + math.log(gamma[h >> 54] / math.sqrt(((h >> 54) + 0.5) / 1024)) - r * (t - b) - r
            best[j] = min(best[j], (ln_a, (h >> 28 ^ t * 2654435761) & (1 << 28) - 1))
    return "".join(f"{x:07X}" for _, x in best)


@pytest.mark.parametrize("samples", [32, 12])
def test_fingerprints_are_the_samples_of_whole_texts(spark, samples):
    rng = random.Random(7)
    blanks = [" ", "  ", "\t", "\n", "\r\n", "\x0b", "\x0c", " \u00a0"]
    some = ["the", "The", "ΟΔΟΣ", "İx", "ß", "a.b", "😀", "ΑΣ", *(f"w{i}" for i in range(30))]
    texts = ["".join(rng.choice(some) + rng.choice(blanks) for _ in range(rng.randrange(1, 90))) for _ in range(30)]
    texts += ["", "x", " ", "\t\n", "onewordonly", "ΑΣΑΣΑΣ", " x", "x ", "x  y", "", "abc def", "abcdef gh", "a" * 9 + " ", "the " * 70]
    got = {r["doc_id"]: r for r in weighted_sampling.fingerprint_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), samples=samples).collect()}
    own = [plain_print(t, samples) for t in texts]
    for i, t in enumerate(texts):
        edited = t[: len(t) - len(t) // 2] + texts[i - 1][: len(t) // 2]
        assert (got[i]["fingerprint"], got[i]["edited_fingerprint"]) == (own[i], plain_print(edited, samples))
        assert got[i]["near_next"] == sum(own[i][k : k + 7] == own[i - 1][k : k + 7] for k in range(0, 7 * samples, 7)) / samples


def test_fingerprints_draw_shared_words_once(spark):
    """Rows out of all Generate nodes: words of the common part are split,
    counted and drawn once for both sides, eight samples of a word a row."""
    docs = spark.createDataFrame([(i, " ".join(f"w{i}_{j}" for j in range(100))) for i in range(40)], "doc_id long, text string")
    df = weighted_sampling.fingerprint_documents(docs)
    assert len(df.collect()) == 40
    made, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name, inner = node.nodeName(), []
        if name == "AdaptiveSparkPlan":
            inner = [node.executedPlan()]
        elif name.endswith("QueryStage"):
            inner = [node.plan()]
        if name == "Generate":
            made += node.metrics().apply("numOutputRows").value()
        todo += inner or [node.children().apply(i) for i in range(node.children().size())]
    assert 0 < made < 40 * 1100  # about 1,800 a text without sharing, in rounds of four


@pytest.mark.parametrize("block", [1 << 20, 200])
def test_decontamination(spark, docs, pairs, block):
    texts = dict(pairs)
    long = max((t or "" for t in texts.values()), key=len).split()
    items = [("b", " ".join(long[100:130])), ("a", "Two, WORDS"), ("c", None), ("d", "!!"), (None, " ".join(long[500:515])), ("a", " ".join(long[120:140])), ("2", "one")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    windows = collections.defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(i)
    got = {r["doc_id"]: r for r in decontaminate.find_contamination(docs, bench, block_bytes=block).collect()}
    for i, t in pairs:
        w, hit, names = words(t), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    hit |= set(range(k, k + size))
                    names |= windows[tuple(w[k : k + size])] - {None}
        r = got[i]
        assert r["n_words"] == len(w) and r["hit_items"] == sorted(names) and r["k"] is None
        assert {k for s in r["hit_spans"] for k in range(s["start"], s["end"])} == hit
    cut = decontaminate.cut_spans(decontaminate.find_contamination(docs, bench))
    assert all(not r["hit_spans"] for r in decontaminate.find_contamination(cut, bench).collect())
    assert {r["doc_id"] for r in cut.collect()} == set(texts)


def test_decontamination_odd_cases(spark, odd, empty):
    none = spark.createDataFrame([], "item_id string, text string")
    assert decontaminate.find_contamination(odd, none).where("size(hit_spans) = 0").count() == 6
    assert decontaminate.find_contamination(empty, none).count() == 0


def test_fingerprints_take_any_ordered_key(spark, docs):
    plain = rows(weighted_sampling.fingerprint_documents(docs))
    named = docs.withColumn("doc_id", F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 9, "0")))
    got = weighted_sampling.fingerprint_documents(named).withColumn("doc_id", F.substring("doc_id", 2, 9).cast("long"))
    assert rows(got) == plain


def test_buckets_are_counted_among_bounds(spark):
    bounds = sorted(random.Random(3).sample(range(1000), 57))
    df = spark.range(0, 1000).withColumn("b", weighted_sampling._bucket(F.col("id"), [float(b) for b in bounds]))
    assert all(r["b"] == sum(x <= r["id"] for x in bounds) for r in df.collect())


def brute_base(t):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 13 <= len(d) <= 19 and (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    return out + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    parts = ["a", "@", ".", "b-", "1", "23", "+", ".4", "(5", "-", " ", "1.2.3.4", "255.1", "4111111111111111", "c@d.e", "@@", "x@y", "+1 (234) 555-1234", "é", "0000"]
    for _ in range(5000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(1, 9)))
        assert pii.base_spans(t) == brute_base(t)


def test_bootstrapping_finds_unseen_identifiers(spark):
    rng = random.Random(4)
    seeds = [f"contact phone: +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} ok" for _ in range(20)]
    data = [(i, t) for i, t in enumerate([*seeds, "contact phone: 0049-7731-abc9 ok", "room 12345678 free", "Ünï a@b.cc, 1.2.3.4", None, ""])]
    got = {r["doc_id"]: [tuple(s) for s in r["pii"]] for r in pii.find_pii(spark.createDataFrame(data, "doc_id long, text string").repartition(3)).collect()}
    assert ("phone", 15, 29, False) in got[20] and got[21] == [] and got[23] == [] and got[24] == []
    for i, t in data:
        assert [s[:3] for s in got[i] if s[3]] == brute_base(t or "")
    clean = pii.redact(pii.find_pii(spark.createDataFrame(data, "doc_id long, text string")))
    assert clean.where("doc_id = 22").first()["text"] == "Ünï [EMAIL], [IP]"
    assert pii.find_pii(clean.drop("pii")).where("exists(pii, x -> x.base)").count() == 0


def test_pii_newly_known_instances_induce_patterns(spark):
    """Round one finds written-out addresses behind ``mail:``; the words before
    them elsewhere become trusted in round two and find what no seed stood near."""
    seeds = [f"mail: user{i}@example.org" for i in range(30)]
    unseen = [f"mail: jo.{c}(at)example" for c in "abcdef"]
    again = [f"reached under handle jo.{c}(at)example then" for c in "abcdef"]
    new = ["reached under handle Zed.Q then", "reached under handle nobody then", "the word mail alone"]
    docs = spark.createDataFrame(list(enumerate([*seeds, *unseen, *again, *new])), "doc_id long, text string").repartition(3)
    marked = lambda **k: {r["doc_id"]: [r["text"][s["start"] : s["end"]] for s in r["pii"] if not s["base"]] for r in pii.find_pii(docs, **k).collect()}
    got = marked()
    assert [got[i] for i in range(30, 36)] == [[f"jo.{c}(at)example"] for c in "abcdef"]
    assert [got[i] for i in range(36, 42)] == [[f"jo.{c}(at)example"] for c in "abcdef"]
    assert got[42] == ["Zed.Q"] and got[43] == [] and got[44] == []
    assert marked(rounds=1)[42] == []  # one round alone can't


def test_pii_pattern_does_not_support_itself(spark):
    """Half of what stands behind ``see`` is unknown: no number of rounds makes it trusted."""
    texts = [f"see a{i}@b.org" for i in range(5)] + [f"see Item-{i}" for i in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for rounds in (1, 3, 6):
        assert pii.trusted_patterns(docs, rounds=rounds).count() == 0


def test_pii_support_holds_beside_unrelated_seeds(spark):
    """Three seeds make a pattern trusted however many other seeds there are."""
    few = [f"badge: a{i}@b.org" for i in range(3)] + [f"two: c{i}@b.org" for i in range(2)]
    many = [f"p{i}: 10.{i // 250}.{i % 250}.7" for i in range(20_000)]
    for texts in (few, few + many):
        got = pii.trusted_patterns(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
        assert [(r["k"], r["kind"], r["confidence"]) for r in got] == [(0, 0, 1.0)]


def test_pii_plain_words_told_from_bytes():
    rng = random.Random(31)
    texts = ["".join(rng.choice(["a", "Z", "é", "7", ".", "-", "(", '"', "=", " ", "\n"]) for _ in range(rng.randint(0, 25))) for _ in range(300)]
    for _, _, s in textcore.slices(pa.array(texts), textcore.SPACED_LOWER):
        lines = pii._Lines(s)
        mention, plain = lines.plain(np.arange(len(s.start)))
        for w in range(len(s.start)):
            own = bytes(s.data[s.start[w] : s.end[w]]).decode()
            bare = re.sub(r"^[^\w]+|[^\w]+$", "", own)
            assert mention[w] == bool(bare) and plain[w] == (bool(bare) and pii._plain(bare)), own


def test_pii_filter_passes_all_members(spark):
    ids = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 5000)
    bits = pii._filter(spark.createDataFrame([(int(i),) for i in ids], "x long"), "x")
    assert pii._passes(bits, ids).all() and pii._passes(bits, ids + 1).mean() < 0.01


def test_pii_query_equals_brute_force(spark):
    from gridstone.llm import queries

    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op4_pii(spark, sf).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        base = brute_base(texts[r["doc_id"]])
        named = [f"{k}:{a}:{b}" for kind in pii.KINDS for k, a, b in base if k == kind]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x[0] == k for x in base) for k in pii.KINDS]
        assert r["base_sha256"] == sha(",".join(named))
        spans = r["spans"].split(",") if r["spans"] else []
        assert [s for s in spans if s.split(":")[0] in pii.KINDS and s in named] == named
        for s in spans:
            kind, a, b = s.split(":")
            if s not in named:
                assert not any(int(a) < y and x < int(b) for _, x, y in base)


def test_pii_joined_patterns_equal_the_broadcast(spark, odd, empty, monkeypatch):
    data = [(i, f"Mail to: u{i}@example.com\nhost addr 10.0.0.{i} and Mail to: tok{i}xyz, addr abc{i}defgh") for i in range(12)]
    data += [(3, data[3][1]), (90, None), (91, ""), (92, "to: only99token")]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    seen = lambda: sorted((r["doc_id"], r["text"] or "", [tuple(s) for s in r["pii"]]) for r in pii.find_pii(docs, confidence=0.2).collect())
    want = seen()
    monkeypatch.setattr(pii, "BLOCK", 0)
    assert seen() == want and any(not s[3] for r in want for s in r[2])
    assert pii.find_pii(odd).count() == 6 and pii.find_pii(empty).count() == 0


def test_pii_odd_cases(odd, empty):
    assert pii.find_pii(odd).count() == 6 and pii.find_pii(empty).count() == 0


@pytest.fixture(scope="module")
def library():
    return encoding.library(BPE)


def test_piece_encoder_equals_the_library(library):
    rng = random.Random(5)
    parts = ["a", "B", "é", " ", "  ", "\n", "\n\n", "\t", ".", ",", "'s", "'", "<|endoftext|>", "<|end", "|>", "1", "23", " ", "　", "ß", "漢", "🙂", "\x1c", "\x85", "-", '"', "\r\n", "can't", "_"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(8000)] + make_texts()
    enc = encoding.PieceEncoder(BPE)
    for x, y, s in textcore.slices(pa.array(texts), textcore.SPACED, 20000):
        ids, n = enc.encode(s.data, s.offsets)
        want = [e.ids for e in library.encode_batch([t or "" for t in texts[x:y]], add_special_tokens=False)]
        assert ids.tolist() == [i for w in want for i in w] and n.tolist() == [len(w) for w in want]


def test_splicing_is_exact(library, texts):
    def whole(t):
        e = library.encode(t, add_special_tokens=False)
        return np.array(e.ids), np.array([a for a, _ in e.offsets], np.int64), np.arange(len(e.ids))

    enc = encoding.PieceEncoder(BPE)
    joined = " ".join(t or "" for t in texts)
    for t in (joined[:20000], joined[:6000].replace(" ", ""), "a" * 5000, "  " * 900 + "é" * 400, joined[20000:50000].replace("e", "é"), "x <|endoftext|> y\n" * 300):
        want = whole(t)[0].tolist()
        for chunk, overlap in ((200, 4), (1000, 64)):
            for encode in (whole, enc.offsets):
                assert [i for p in token_counts.splice(t, encode, chunk, overlap) for i in p.tolist()] == want
        ids, places, numbers = enc.offsets(t)
        starts = whole(t)[1]
        assert ids.tolist() == want and (starts[numbers] == places).all() and (np.diff(places) > 0).all()
    assert [p.tolist() for p in token_counts.splice("", enc.offsets)] == [[]]


def test_token_counts(docs, pairs, odd, empty, library):
    for huge in (65536, 500):
        got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.count_tokens(docs, BPE, huge=huge, chunk=300, overlap=16).collect()}
        for i, t in pairs:
            n = len(library.encode(t or "", add_special_tokens=False).ids)
            assert got[i] == (len((t or "").encode()), n, n > 1024)
    assert token_counts.count_tokens(odd, BPE).count() == 6 and token_counts.count_tokens(empty, BPE).count() == 0


def check_packing(found, want_ids, capacity):
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in found:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for i, ids in want_ids.items():
        own = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(-(-len(ids) // capacity))) and all(r["length"] == capacity for r in own[1:])
        at = 0
        for r in own:
            part = np.array(ids[at : at + r["length"]], "<u4")
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(part.tobytes())
            at += r["length"]
        assert at == len(ids)
    for group in by_sequence.values():
        at = 0
        for r in sorted(group, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by_sequence)


@pytest.mark.parametrize("capacity", [1024, 50])
def test_packing(docs, pairs, capacity, library):
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [2] for i, t in pairs}
    got = packing.pack_documents(docs, BPE, capacity).collect()
    n = check_packing(got, ids, capacity)
    assert n <= 1.1 * sum(map(len, ids.values())) / capacity + 1


def test_benchmark_segments_hold_every_window_once(spark):
    rng = random.Random(2)
    for n, size in ((10, 4), (3, 7), (1, 1)):
        texts = [" ".join(f"w{rng.randint(0, 50)}" for _ in range(rng.choice([0, 1, n - 1, n, n + 1, 40]))) for _ in range(30)]
        batch = pa.RecordBatch.from_arrays([pa.array([str(i) for i in range(30)]), pa.array(texts)], ["id", "t"])
        got = collections.Counter()
        for out in decontaminate._segments(n, size)([batch]):
            for i, t in zip(*(c.to_pylist() for c in out.columns), strict=True):
                w = t.split()
                got.update((i, tuple(w[k : k + min(n, len(w))])) for k in range(max(1, len(w) - n + 1)))
        want = collections.Counter()
        for i, t in enumerate(texts):
            w = t.split()
            want.update((str(i), tuple(w[k : k + min(n, len(w))])) for k in range(max(1, len(w) - n + 1)) if w)
        assert got == want


def test_packing_odd_cases(odd, empty):
    got = packing.pack_documents(odd, BPE).collect()
    assert len(got) == 6 and packing.pack_documents(empty, BPE).count() == 0
    held = packing.pack_documents(odd, BPE, with_ids=True).where("doc_id = 7").first()
    assert bytes(held["ids"]) == (2).to_bytes(4, "little")


def optimum(sizes, capacity):
    """Fewest bins by search."""
    best = len(sizes)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for b in {x: j for j, x in enumerate(bins)}.values():
            if bins[b] + sizes[i] <= capacity:
                place(i + 1, [*bins[:b], bins[b] + sizes[i], *bins[b + 1 :]])
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best


def test_dominance_never_costs_a_bin():
    rng = random.Random(7)
    triples = 0
    for _ in range(1500):
        capacity = rng.randint(8, 20)
        sizes = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 8))), reverse=True)
        counts = collections.Counter(sizes)
        fixed, left = packing.dominance(dict(counts), capacity)
        used = collections.Counter(s for c, n in fixed for s in c for _ in range(n))
        assert used + collections.Counter(left) == counts and all(sum(c) <= capacity for c, _ in fixed)
        triples += any(len(c) == 3 for c, _ in fixed)
        rest = [s for s, n in sorted(left.items(), reverse=True) for _ in range(n)]
        assert sum(n for _, n in fixed) + optimum(rest, capacity) == optimum(sizes, capacity)
        plan = packing.plan(dict(counts), capacity)
        assert collections.Counter(s for c, n in plan for s in c for _ in range(n)) == counts and all(sum(c) <= capacity for c, _ in plan)


    assert triples > 5


def test_dominance_takes_as_many_steps_as_sizes():
    for counts in ({1000: 10**9, 20: 10**9}, {1000: 10**9, 24: 10**9 + 1, 900: 7, 100: 3 * 10**9}, {s: 10**8 + s for s in range(1, 1025)}):
        plan = packing.plan(dict(counts), 1024)
        held = collections.Counter()
        for c, n in plan:
            assert sum(c) <= 1024
            for s in c:
                held[s] += n
        assert held == counts and len(plan) <= 8 * len(counts)


def test_vocabularies_without_provable_cuts_are_refused(tmp_path):
    import json

    with open(BPE, encoding="utf-8") as f:
        made = json.load(f)
    encoding.supported(BPE)
    token = made["added_tokens"][0]
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"added_tokens": [token | {"content": "<a b>"}]}, {"added_tokens": [token | {"content": "a.b"}]}, {"added_tokens": [token | {"lstrip": True}]}):
        (tmp_path / "v.json").write_text(json.dumps(made | change))
        with pytest.raises(ValueError):
            encoding.supported(str(tmp_path / "v.json"))


def test_sharding(docs, pairs, odd, empty):
    got = {r["doc_id"]: r for r in sharding.shard_documents(docs, [1.0] * 24).collect()}
    for i, t in pairs:
        r = got[i]
        assert (r["size"], r["text_crc32"], r["law"]) == (len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), "key")
        assert r["grown_shard"] in (r["shard"], 24)
    by = collections.defaultdict(list)
    for r in got.values():
        by[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sharding.shard_documents(empty, [1.0]).count() == 0
    twice = sharding.shard_documents(odd, [1.0, 2.0]).where("doc_id = 5").collect()
    assert len({r["shard"] for r in twice}) == 1 and len({r["slot"] for r in twice}) == 2
    with pytest.raises(ValueError):
        sharding.rendezvous(F.lit(1), [0.0])


def test_rendezvous_shares_follow_weights(spark):
    got = dict(spark.range(20000).groupBy(sharding.rendezvous(F.col("id"), [1.0, 3.0]).alias("s")).count().collect())
    assert 0.22 < got[0] / 20000 < 0.28


def test_quality_learns_and_leaves_held_out_rows_alone(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = quality.held_out(F.col("doc_id"))
    kept = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(50)}
    assert {r[0]: r[1] for r in docs.select("doc_id", out).where("doc_id < 50").collect()} == kept
    flipped = labels.withColumn("quality", F.when(out, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.train(docs, labels), quality.train(docs, flipped)
    assert np.array_equal(a.leaf, b.leaf) and np.array_equal(a.cut, b.cut)
    scored = quality.score_quality(docs, a).join(labels, "doc_id").where(out).select("quality", "score").collect()
    good, bad = [r[1] for r in scored if r[0] == 1], [r[1] for r in scored if r[0] == 0]
    assert np.mean([g > x for g in good for x in bad]) > 0.97 and np.mean([g >= 0.3 for g in good]) > 0.95


def test_quality_odd_cases(spark, odd, empty, docs):
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    got = quality.score_quality(odd, model, name="p")
    assert got.count() == 6 and got.where("p between 0 and 1").count() == 6
    assert quality.score_quality(empty, model).count() == 0


def test_trees_walk_as_they_grew():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    t = quality.grow(x, y, trees=30)
    assert ((t.score(x) > 0.5) == y).mean() > 0.97

    def walk(row):
        out = t.base
        for feature, cut, leaf in zip(t.feature, t.cut, t.leaf, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + (row[feature[node]] > cut[node])
            out += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-out))

    assert np.allclose(t.score(x[:20]), [walk(r) for r in x[:20]])


def brute_classes(pairs):
    sets = {}
    for i, t in pairs:
        w = words(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent, links = {i: i for i in sets}, collections.Counter()

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 10 * both >= 8 * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [(i, find(i), links[i]) for i in ids]


@pytest.mark.parametrize("chunk, piece", [(256, 4096), (4, 3)])
def test_near_join(docs, pairs, chunk, piece, monkeypatch):
    monkeypatch.setattr(near_join, "CHUNK_NODES", chunk)
    monkeypatch.setattr(near_join, "PIECE", piece)
    got = rows(near_join.near_classes(docs))
    assert sorted(got) == brute_classes(pairs)
    kept = near_join.first_of_class(docs, near_join.near_classes(docs))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c, _ in got})


def test_near_join_odd_cases(odd, empty):
    got = sorted(rows(near_join.near_classes(odd)), key=str)
    assert got == sorted([(5, 5, 2), (5, 5, 2), (6, 5, 2), (7, 7, 0), (None, None, 0), (None, None, 0)], key=str)
    assert near_join.near_classes(empty).count() == 0
    assert sorted((r["doc_id"] for r in near_join.first_of_class(odd, near_join.near_classes(odd)).collect()), key=str) == [5, 7, None, None]


def test_first_of_class_is_defined_for_shared_keys(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    data = [(5, a), (5, b), (6, a), (7, "alone one"), (7, "alone two"), (None, a), (8, None)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = [rows(near_join.first_of_class(d, near_join.near_classes(d))) for d in (df, df.orderBy(F.desc("text")).repartition(3))]
    assert got[0] == got[1] and [r[0] for r in got[0]] == [5, 7, 7, 8, None]


def test_links_counted_densely_and_sparsely_agree():
    from fractions import Fraction

    rng = np.random.default_rng(9)
    core = rng.integers(1, 1 << 60, 100).astype(np.uint64)
    nodes = []
    for i in range(80):
        own = np.unique(np.concatenate([rng.choice(core, 90, replace=False), rng.integers(1, 1 << 60, int(rng.integers(0, 12))).astype(np.uint64)]))
        nodes.append((i + 1, int(rng.integers(1, 4)), i % 3, own.tobytes()))
    ids, links, root = near_join._linked(nodes, True, Fraction(4, 5))
    sets = [set(np.frombuffer(x[3], np.uint64).tolist()) for x in nodes]
    want = [sum(nodes[j][1] for j in range(80) if j != i and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])) for i in range(80)]
    assert links.tolist() == want and ids.tolist() == list(range(1, 81)) and len(root) == 80


def test_depth_reaches_the_target_recall():
    depth = near_join.depth_for(0.8, 32, 8, 0.99999)
    assert 1 - (1 - 0.8**depth) ** 32 >= 0.99999 > 1 - (1 - 0.8 ** (depth + 1)) ** 32


def test_spanning_forest_joins_all_that_agree():
    rng = np.random.default_rng(5)
    labels = rng.integers(0, 3, (60, 16)).astype(np.uint8)
    row, start, agree = near_join._spanning(labels, 9)
    same = (labels[:, None] == labels[None]).sum(2)
    assert (same[row, start] == agree).all() and (agree >= 9).all()
    label = list(range(60))
    for _ in range(60):
        for i in range(60):
            label[i] = min(label[j] for j in range(60) if same[i, j] >= 9)
    tied = list(range(60))
    for _ in range(60):
        for a, b in zip(row.tolist(), start.tolist(), strict=True):
            tied[a] = tied[b] = min(tied[a], tied[b])
    assert tied == label and len(row) == 60 - len(set(label))


def test_forest_stops_at_the_measured_recall(spark, docs, monkeypatch):
    """Near copies alone need no shorter prefixes; links at the threshold do."""
    asked = []
    level = near_join._level
    monkeypatch.setattr(near_join, "_level", lambda leaves, nodes, depth, *a: asked.append(depth) or level(leaves, nodes, depth, *a))
    text = [f"w{i}" for i in range(400)]
    for edits, depths in ((1, [8]), (7, [8, 7])):
        del asked[:]
        texts = [" ".join(text)] + [" ".join("x" if k % (400 // edits) == 3 + i else w for k, w in enumerate(text)) for i in range(12)]
        got = rows(near_join.near_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
        assert sorted(got) == brute_classes(list(enumerate(texts)))
        assert asked[: len(depths)] == depths and (edits > 1 or len(asked) == 1)


def test_license_scan(spark, odd, empty):
    data = [
        (1, "Licensed under the Apache License, Version 2.0.\nx"), (2, "MIT  license and the mit-License; cc by cc by-nc"), (3, "licensed under apache license version 2\nfoo"),
        (4, None), (5, ""), (6, "under the license"), (7, "This program is licensed under the GNU Public License, version 2"), (10, "Redistribution and use\nin source and binary forms, with or\n without MODIFICATION, are permitted\nprovided that the following conditions are met"),
        (11, "the of and " * 3000 + "Source Code Form is subject to the terms of the Mozilla Public License"), (12, "licensed far from the " * 400 + "apache version 2 0"), (13, "M\u0130T license MIT l\u0130cense MIT L\u0130CENSE mit LICENSE\u212a MIT LICENSE THIS WOR\u212a IS LICENSED UNDER THE GNU GENERAL PUBLIC \u00c4 version 3"), (8, "w " * 5000 + "GNU general\npublic license"), (9, "ccby cc  by"),
    ]
    got = {r["doc_id"]: r for r in license_scan.scan_licenses(spark.createDataFrame(data, "doc_id long, text string").repartition(2)).collect()}
    for i, t in data:
        w, places, base = words(t), [], set()
        for phrase, label in license_scan.PHRASES.items():
            q = phrase.split()
            hits = [k for k in range(len(w)) if w[k : k + len(q)] == q]
            places += hits
            base |= {label} if hits else set()
        found, share = set(base), 0.0
        for label, bodies in license_scan.TEMPLATES.items():
            for body in bodies:
                own = set(words(body))
                wide = -(-len(words(body)) * 5 // 4)
                part = max((len(own & set(w[k : k + wide])) / len(own) for k in range(len(w))), default=0)
                if part >= 0.8:
                    found.add(label)
                    share = max(share, part)
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(w), len(places), min(places, default=None), max(places, default=None))
        assert (r["base_labels"], r["labels"]) == (",".join(sorted(base)), ",".join(sorted(found)))
        assert r["score"] == pytest.approx(1.0 if places else share)
    assert got[7]["labels"] == "gpl-2"
    assert license_scan.scan_licenses(odd).count() == 6 and license_scan.scan_licenses(empty).count() == 0


def test_license_scan_finds_wrapped_notices(spark):
    mit = "# Permission is hereby granted, free of charge, to any person obtaining a copy\n# of this software and associated documentation files"
    bsd = "Redistribution and use in source and binary forms, with or without\r\nmodification, are permitted provided that the following conditions are met"
    apart = "Licensed under\n" + "other words here\n" * 5 + "the Apache Lizense, Version 2.0"
    data = [(1, mit), (2, "x " * 400 + "\n" + bsd + "\n" + "y " * 400), (3, bsd.replace(" ", "\n")), (4, apart), (5, bsd), (5, bsd), (6, "by CC\n\nunder 4 0"), (None, mit)]
    got = rows(license_scan.scan_licenses(spark.createDataFrame(data, "doc_id long, text string").repartition(2)), "doc_id", "labels", "score")
    want = [(1, "mit-notice", 1.0), (2, "bsd", 1.0), (3, "bsd", 1.0), (4, "", 0.0), (5, "bsd", 1.0), (5, "bsd", 1.0), (6, "cc-by-4.0", 5 / 6), (None, "mit-notice", 1.0)]
    assert got == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))
