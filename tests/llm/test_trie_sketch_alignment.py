"""Burst tries, odd sketches and tokenizer alignment against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.llm import alignment, burst_trie, odd_sketch
from tests.conftest import SF_SMALL
from tests.llm import helpers as H

TURNS = "conv_id long, turn long, role string, text string"


# ---- burst trie --------------------------------------------------------------------------------------------------

def turn_id(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def plain_trie(rows):
    """Counter of ``NODE`` rows by listing every prefix of every rebuilt conversation."""
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, turn_id(role or "", text or ""), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(v, key=lambda x: x[:3])] for c, v in own.items()}
    members = defaultdict(list)
    length = {}
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4
        seq = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:])
        length[c] = len(seq)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for p, m in members.items():
        words = (len(m) - 1) * len(H.WORD.findall(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += words
    return Counter((m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p],
                    H.sha(",".join(str(c) for c in m if length[c] == len(p)).encode())) for p, m in members.items())


def awkward_turns():
    rng, rows = np.random.default_rng(5), []
    for c in range(-40, 130):
        if c % 7 == 3:
            continue
        of = np.random.default_rng(abs(c if c % 3 else 1) % 11)
        for k in range(int(rng.integers(1, 4)) if c % 5 else int(of.integers(1, 14))):
            turn = (k, k, k, None, 0)[int(of.integers(0, 5))] if k else k
            rows.append((c, turn, ("u", None, "")[int(of.integers(0, 3))], (f"a b {of.integers(0, 2)}", None, "x")[int(of.integers(0, 3))]))
    rows += [(None, 1, "a", "b"), (40, 0, "a", "a"), (40, 0, "a", "a"), (61, 5, "u", "w " * 30_000)]
    return rows + [(c, k // 3, "u", "same") for c in (60, 61) for k in range(50)]


@pytest.mark.parametrize("sizes", [(3, 2, 4, 2, 2), (64, 2048, 8192, 1024, 4096)])
def test_trie_equals_listing_all_prefixes(spark, monkeypatch, sizes):
    for name, value in zip(("SEGMENT", "CONTAINER", "SHARD", "BUCKET", "ENDS"), sizes):
        monkeypatch.setattr(burst_trie, name, value)
    rows = awkward_turns()
    df = spark.createDataFrame(rows, TURNS).select("*", *[F.lit("x").alias(c) for c in ("id", "depth", "place", "K", "low")]).repartition(5)
    assert Counter(map(tuple, burst_trie.prefix_trie(df).collect())) == plain_trie(rows)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert burst_trie.prefix_trie(spark.createDataFrame([], TURNS)).collect() == []
    lone = next(c for c in range(1, 19) if zlib.crc32(str(c).encode()) % 4 == 3)  # borrows from a conversation that is absent
    rows = [(lone, 1, "u", "a"), (lone, 2, "u", "b")]
    assert list(map(tuple, burst_trie.prefix_trie(spark.createDataFrame(rows, TURNS)).collect())) == [(lone, 0, None, 1, 0, 1, 0, H.sha(str(lone).encode()))]


# ---- odd sketches ------------------------------------------------------------------------------------------------

def word_pairs(text):
    w = H.lower(text).split()
    return frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset(w)


def plain_components(rows):
    """Counter of (doc_id, n_shingles, component_id, kept) by comparing all pairs of sets."""
    sets = [word_pairs(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    ids = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        ids[find(k)] += [i] if i is not None else []
    return Counter((i, len(sets[k]), min(ids[find(k)], default=None), i == min(ids[find(k)], default=None)) for k, (i, _) in enumerate(rows))


def near_copies(n, changed):
    rng = np.random.default_rng(3)
    base, out = [f"w{i}" for i in rng.integers(0, 3000, 200)], []
    for k in range(n):
        words = list(base)
        for j in rng.integers(0, len(words), changed):
            words[j] = f"z{rng.integers(0, 10**6)}"
        out.append((10**6 + k, " ".join(words)))
    return out


@pytest.mark.parametrize("few", [0, 4])  # 0: every open query is compared with whole components
def test_odd_sketch_components_equal_all_pairs(spark, monkeypatch, few):
    monkeypatch.setattr(odd_sketch, "FEW", few)
    monkeypatch.setattr(odd_sketch, "QUERIES", 8)  # several cells in a band
    monkeypatch.setattr(odd_sketch, "DATA", 16)
    rows = [(i, t) for i, t, *_ in H.DOCS] + near_copies(80, 11) + [(90, "One"), (91, "one"), (92, "x y z w v u t s r q p o"), (93, "x y z w v u t s r q p")]
    d = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit("x").alias(c) for c in (*H.EXTRA, "key", "BANDS", "sid", "sketch", "u", "v")])
    got = odd_sketch.near_dedup(d.repartition(3)).select("doc_id", "n_shingles", "component_id", "kept")
    assert Counter(map(tuple, got.collect())) == plain_components(rows)
    assert odd_sketch.near_dedup(d.limit(0)).count() == 0


def test_odd_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    for similar in (0.7, 0.8, 0.9, 0.97):
        errors, shared_band = [], 0
        for _ in range(60):
            x = rng.integers(0, 1 << 63, 1000, np.uint64)
            own = round(1000 * (1 - similar) / (1 + similar))
            y = np.concatenate((x[own:], rng.integers(0, 1 << 63, own, np.uint64)))
            a, b = odd_sketch.minhash(x), odd_sketch.minhash(y)
            bits = int(np.bitwise_count((odd_sketch.odd_sketch(a) ^ odd_sketch.odd_sketch(b)).view(np.uint64)).sum())
            errors.append(1 + odd_sketch.BITS / (4 * odd_sketch.SAMPLES) * math.log(1 - 2 * bits / odd_sketch.BITS) - similar)
            shared_band += bool((odd_sketch.bands(a) == odd_sketch.bands(b)).any())
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06
        assert similar < 0.8 or shared_band == 60


# ---- alignment ---------------------------------------------------------------------------------------------------

ODD_TEXTS = [None, "", " ", "  x  \n y ", "日é\U0001F600 x\ttab  two\n", "a▁b c", "<|endoftext|> <s> </s> <unk> <0x41>", "\x1c \x00   \xa0x  　", "don't   stop\r\n\r\n  now 123 's",
             "x" * 3000 + " end", "ab \n" * 500, "Ünïcode, ÄÖ. wörd;x!? ... a.b,c \n\nq", ".start", "\nline", "ﬁ Å é ‍👩‍👩‍👧"]


@pytest.fixture(scope="module")
def tokenizers():
    return alignment.Tokenizers(alignment.FOLDER)


def plain_alignment(t, text):
    """(A ids, B ids, group text, links) of a whole text by the tokens' bytes; None without tokens."""
    if not text:
        return None
    raw = (" " + text).encode()
    a, b = t.first.encode(" " + text, add_special_tokens=False).ids, t.second.encode(text)
    if b"".join(t.a_bytes[i] for i in a) != raw or b"".join(t.b_bytes[i] for i in b) != raw:
        return None
    ends = lambda ids, table: np.cumsum([len(table[i]) for i in ids]).tolist()
    a_end, b_end = ends(a, t.a_bytes), ends(b, t.b_bytes)
    cut = sorted({*a_end} & {*b_end})
    groups, links, i, j = [], [], 0, 0
    for c in cut:
        x, y = i, j
        while i < len(a) and a_end[i] <= c:
            i += 1
        while j < len(b) and b_end[j] <= c:
            j += 1
        groups.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j])))
        links += [(a[p], b[q]) for p in range(x, i) for q in range(y, j)
                  if max(([0, *a_end])[p], ([0, *b_end])[q]) < min(a_end[p], b_end[q])]
    return a, b, groups, links


def test_alignment_equals_whole_texts(spark, tokenizers):
    rows = [(-k, t) for k, t in enumerate(ODD_TEXTS, 1)] + [(i, t) for i, t, *_ in H.DOCS]
    rows += [(r["doc_id"] + 1000, r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    each = [plain_alignment(tokenizers, t) for _, t in rows]
    count = Counter(p for x in each if x for p in set(x[3]))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    want = Counter((i, len(x[0]), len(x[1]), len(x[2]), len(x[3]), sum(count[p] == best[p[0]] for p in x[3]), sum(count[p] for p in x[3]), H.sha(";".join(x[2]).encode()))
                   if x else (i, 0, 0, 0, 0, 0, 0, "") for (i, _), x in zip(rows, each))
    d = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit("x").alias(c) for c in ("batch", "Pairs", "at", "count", "to")])
    assert Counter(map(tuple, alignment.align(d.repartition(3)).collect())) == want
    assert alignment.align(d.limit(0)).count() == 0


def test_memory_forgets_and_batches_stay_right(spark, tokenizers, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = Counter(map(tuple, alignment.align(docs).collect()))
    monkeypatch.setattr(alignment, "REMEMBERED", 500)
    monkeypatch.setattr(alignment, "BATCH_LINKS", 3000)
    assert Counter(map(tuple, alignment.align(docs.repartition(2)).collect())) == want


def test_no_piece_goes_over_a_certain_cut(tokenizers):
    pieces = [b.decode("utf-8", "replace") for b in tokenizers.b_bytes]
    assert not [p for p in pieces if " " in p.lstrip(" ") or ("\n" in p and p != "\n") or re.search(r"[A-Za-zÀ-ÖØ-öø-ÿ][.,;:!?]", p)]


def test_coarse_cuts_agree_with_decoded_lengths(tokenizers):
    for text in filter(None, ODD_TEXTS):
        cuts = tokenizers.cuts(" " + text)
        if cuts:
            assert cuts.a_end.tolist() == np.cumsum(tokenizers.a_size[cuts.a]).tolist()
            assert cuts.b_end.tolist() == np.cumsum(tokenizers.b_size[cuts.b]).tolist()
