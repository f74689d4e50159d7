"""Each operator on awkward rows and on the smallest tables, against plain Python or DuckDB."""

import math
import textwrap
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from cohortkit.llm import common, exact_dedup, license_scan, mixing, ngram_lm, packing, quality_rules, secret_scan, simhash, toxicity, url_filters
from cohortkit.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL
from tests.llm import helpers as H

LABELS = "doc_id long, quality int, toxic int"


def rows(df):
    return [r.asDict() for r in df.collect()]


def same(got, want):
    key = lambda r: repr(sorted(r.items()))
    assert sorted(map(key, got)) == sorted(map(key, want))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    cur = con.execute(ORACLE_SQL[name])
    names = [c[0] for c in cur.description]
    got = rows(QUERIES[name](spark, SF_SMALL))
    same([{k: r[k] for k in names} for r in got], [dict(zip(names, r)) for r in cur.fetchall()])


# ---- URL filters -------------------------------------------------------------------------------------------------

URLS = ["http://Example.NET/en/1", "https://a.example.net/fr/", "ftp://net/", "http://net", "http://xnet/en/", "http://b.org/fr/?q", "http://org/frx",
        "http://example.com/de/x#y", "http://example.com/de", "no scheme.net/", None, "", "http://", "http:///en/", "x://a..net/", "http://www.example.com?u=://net/", "http://net/\n"]


def rule_of(host, path, rules):
    fit = [(h + p, h, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit, key=lambda r: (len(r[0]), len(r[1]), r[2]), default=(None, None, "allow"))


def test_url_rules_on_awkward_urls(spark):
    rules = url_filters.RULES + [("a.example.net", "/f", "allow"), ("com", "", "block"), ("com", "", "allow")]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)] + [(None, URLS[0], "x", "y")], "page_id long, url string, host string, rule string")
    got = rows(url_filters.filter_urls(pages, spark.createDataFrame(rules, "host string, path string, action string"), ["page_id"]))
    assert len(got) == len(URLS) + 1
    for r in got:
        u = URLS[r["page_id"] or 0]
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, tail = rest[:cut].lower(), rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
        rule, _, action = rule_of(host, path, rules)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, action), u


def test_url_rules_may_be_none_and_pages_empty(spark):
    none = spark.createDataFrame([], "host string, path string, action string")
    assert rows(url_filters.filter_urls(spark.createDataFrame([(1, "http://net/")], "page_id long, url string"), none, ["page_id"]))[0]["verdict"] == "allow"
    assert rows(url_filters.filter_urls(spark.createDataFrame([], "page_id long, url string"), url_filters.contract_rules(spark), ["page_id"])) == []


# ---- exact dedup -------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 7, 5000])
def test_perfect_hash_is_minimal_and_rejects_nonmembers(n):
    keys = np.random.default_rng(n).integers(0, 2**63, (2 * n, 4)).astype(np.uint64)
    sizes, bits = exact_dedup.build(keys[:n])
    assert sorted(exact_dedup.slots(keys[:n], sizes, bits)) == list(range(n))
    held = keys[:n][np.argsort(exact_dedup.slots(keys[:n], sizes, bits))]
    at = exact_dedup.slots(keys[n:], sizes, bits)
    assert not ((at >= 0) & (held[at] == keys[n:]).all(axis=1)).any()


def test_exact_dedup_marks_one_row_of_each_group(spark):
    got = rows(exact_dedup.mark(H.docs(spark, extra=True)))
    groups = defaultdict(list)
    for i, t, *_ in H.DOCS:
        groups[H.lower(t)].append(i)
    want = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want.update((i, keep, len(ids), H.sha(t)) for i in ids)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)


def test_drop_copies_keeps_columns_and_one_row(spark):
    d = H.docs(spark, extra=True)
    out = exact_dedup.drop_copies(d)
    assert out.schema == d.schema
    assert Counter(r["doc_id"] for r in rows(out)) == Counter(r["doc_id"] for r in rows(exact_dedup.mark(d)) if r["kept"])
    assert exact_dedup.drop_copies(d.limit(0)).count() == 0 and exact_dedup.mark(d.limit(0)).count() == 0


# ---- mixing ------------------------------------------------------------------------------------------------------

def test_sainte_lague_equals_seat_by_seat():
    r = np.random.default_rng(1)
    for _ in range(60):
        votes = [float(v) for v in r.integers(0, 50, 6)]
        most, seats = [int(m) for m in r.integers(0, 30, 6)], int(r.integers(0, 60))
        slow = [0] * 6
        for _ in range(seats):
            open_ = [i for i in range(6) if votes[i] > 0 and slow[i] < most[i]]
            if open_:
                slow[max(open_, key=lambda i: (votes[i] / (2 * slow[i] + 1), -i))] += 1
        assert mixing.sainte_lague(votes, seats, most) == slow


def test_mix_follows_targets_and_reruns_agree(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    a, b = rows(mixing.mixed(docs)), rows(mixing.mixed(docs.repartition(3)))
    same(a, b)
    src = {r["doc_id"]: r["source"] for r in docs.select("doc_id", "source").collect()}
    taken, size, target = Counter(), Counter(), {}
    for r in a:
        assert 0 <= r["taken"] <= 2 * r["size"]
        s = src[r["doc_id"]]
        taken[s] += r["taken"]
        size[s] += r["size"]
        target[s] = r["target"]
    names = sorted(size)
    want = mixing.targets([size[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5 * sum(size.values()))
    for s, t in zip(names, want):
        assert math.isclose(target[s], t, rel_tol=1e-12) and target[s] <= 2 * size[s]
        assert abs(taken[s] - t) <= 2 * mixing.BLOCK_WORDS
    assert math.isclose(sum(target.values()), 1.5 * sum(size.values()), rel_tol=1e-9)


def test_mix_of_awkward_rows(spark):
    d = H.docs(spark, H.DOCS + [H.DOCS[7]] * 3, extra=True)
    got = rows(mixing.mixed(d))
    assert len(got) == len(H.DOCS) + 3 and all(r["taken"] <= 2 * r["size"] for r in got)
    out = mixing.apply_mix(d)
    assert out.schema == d.schema
    pieces = rows(out)
    assert sum(len(H.WORD.findall(r["text"])) for r in pieces) == sum(r["taken"] for r in got)
    whole = {(r[0], r[1]) for r in H.DOCS}
    assert all((r["doc_id"], r["text"]) in whole or any(i == r["doc_id"] and r["text"] in (t or "") for i, t, *_ in H.DOCS) for r in pieces)
    assert all(r["n_chars"] == len(r["text"]) for r in pieces)
    assert mixing.mixed(d.limit(0)).count() == 0 and mixing.apply_mix(d.limit(0)).count() == 0


# ---- packing -----------------------------------------------------------------------------------------------------

def test_packing_places_every_word_once(spark):
    d = H.docs(spark, H.DOCS * 3, extra=True)
    got = rows(packing.pack(d))
    size = Counter(len(H.WORD.findall(t or "")) for _, t, *_ in H.DOCS * 3)
    assert sum(r["n_words"] for r in got) == sum(k * v for k, v in size.items())
    bins = defaultdict(list)
    for r in got:
        assert r["start_word"] == r["piece"] * max(packing.LENGTHS) and (r["n_words"] > 0) == (r["bin_id"] is not None)
        if r["n_words"]:
            bins[r["bin_id"]].append(r)
    for b in bins.values():
        used = 0
        for r in sorted(b, key=lambda r: r["offset"]):
            assert r["offset"] == used
            used += r["n_words"]
        assert {r["capacity"] for r in b} == {min(c for c in packing.LENGTHS if c >= used)}
    assert packing.pack(d.limit(0)).count() == 0


def test_best_fit_is_near_the_least_cost():
    r = np.random.default_rng(3)
    for _ in range(20):
        sizes = [int(s) for s in r.integers(1, 60, 40)]
        placed = packing.best_fit(sizes, (16, 32, 64))
        caps = {b: c for b, c, _ in placed}
        assert sum(caps.values()) <= 1.12 * sum(sizes) + 64


def test_packing_does_not_depend_on_the_splits(spark):
    d = H.docs(spark, [(i % 50, f"{'w ' * (i * 37 % 900)}{i}", "en", "a") for i in range(400)] + H.DOCS * 3)
    packed = [Counter(packing.pack(x).collect()) for x in (d.coalesce(1), d.repartition(3), d.repartition(7, "n_chars"))]
    assert packed[0] == packed[1] == packed[2]


def test_copies_of_a_row_are_numbered(spark, monkeypatch):
    monkeypatch.setattr(common, "RUN", 10)
    got = common.numbered(spark.createDataFrame([("a", 25), ("b", 1), (None, 10)], "k string, n long"), "n", "copy").collect()
    assert Counter(map(tuple, got)) == Counter([("a", i) for i in range(25)] + [("b", 0)] + [(None, i) for i in range(10)])


def test_best_fit_against_every_packing():
    lengths, ratios = (4, 8, 16), []

    def partitions(items):
        if not items:
            yield []
            return
        for rest in partitions(items[1:]):
            yield [[items[0]], *rest]
            for i, b in enumerate(rest):
                yield [*rest[:i], [items[0], *b], *rest[i + 1:]]

    cost = lambda bins: sum(min(c for c in lengths if c >= sum(b)) + packing.BIN_COST for b in bins)
    r = np.random.default_rng(5)
    for _ in range(60):
        sizes = [int(s) for s in r.integers(1, 17, int(r.integers(1, 8)))]
        placed, bins = packing.best_fit(sizes, lengths), defaultdict(list)
        for size, (b, _, _) in zip(sizes, placed):
            bins[b].append(size)
        least = min(cost(p) for p in partitions(sizes) if all(sum(b) <= max(lengths) for b in p))
        ratios.append(cost(bins.values()) / least)
    assert min(ratios) >= 1 and np.mean(ratios) < 1.03 and max(ratios) < 1.4


# ---- toxicity ----------------------------------------------------------------------------------------------------

def test_machine_learns_a_pair_that_single_terms_miss():
    def texts(n, seed):
        r, out, y = np.random.default_rng(seed), [], []
        for _ in range(n):
            a, b = (bool(v < 0.5) for v in r.random(2))
            out.append(" ".join([f"n{r.integers(0, 40)}" for _ in range(6)] + ["insult"] * a + ["group"] * b).encode())
            y.append(a == b)  # both or neither: no weight of a single term helps
        return out, np.array(y)

    train, y = texts(800, 0)
    ask, want = texts(300, 1)
    m = toxicity.fit([toxicity.hashed(t) for t in train], y.astype(float))
    right = lambda: np.mean([(s >= 0.5) == w for s, w in zip(map(m.scorer(), ask), want)])
    assert right() > 0.95
    m.v[:] = 0
    assert right() < 0.85


def test_machine_scores_and_slopes_by_brute_force():
    r = np.random.default_rng(5)
    docs = [np.unique(r.integers(0, 9, r.integers(0, 7))).astype(np.uint32) for _ in range(12)] + [np.zeros(0, np.uint32)]
    y = (r.random(len(docs)) < 0.4).astype(float)
    ids, (batch,) = toxicity.batches_of(docs, y, np.arange(len(docs)))
    w, v, bias = r.normal(0, 1, len(ids)), r.normal(0, 1, (len(ids), 3)), 0.3
    sets = [[int(np.searchsorted(ids, t)) for t in d] for d in docs]

    def value(t, w, v):
        return bias + sum(w[i] for i in t) + sum(v[i] @ v[j] for a, i in enumerate(t) for j in t[a + 1:])

    def loss(w, v):
        cost = [np.log1p(np.exp(-z)) * toxicity.TOXIC_WEIGHT if c else np.log1p(np.exp(z)) for z, c in zip((value(t, w, v) for t in sets), y)]
        return sum(cost) / len(sets)

    z, s = toxicity.margins(batch, bias, w, v)
    assert np.allclose(z, [value(t, w, v) for t in sets])
    assert np.allclose(toxicity.margins(batch, bias, w, None)[0], [value(t, w, 0 * v) for t in sets])
    dw, dv = toxicity.slopes(batch, toxicity.loss_slope(z, y), s, v)
    for i, term in enumerate(batch[4]):
        step = np.zeros(len(ids))
        step[term] = 1e-6
        assert abs(dw[i] - (loss(w + step, v) - loss(w - step, v)) / 2e-6) < 1e-6
        for k in range(3):
            more = np.outer(step, np.eye(3)[k])
            assert abs(dv[i, k] - (loss(w, v + more) - loss(w, v - more)) / 2e-6) < 1e-6


def test_scorer_by_brute_force():
    text = b"An insult, to the GROUP! insult " + "Ünknown wörd".encode()
    ids = toxicity.hashed(text)[::2]
    r = np.random.default_rng(2)
    m = toxicity.Machine(ids, -0.2, r.normal(0, 1, len(ids)), r.normal(0, 0.3, (len(ids), 4)))
    z = m.bias + m.w.sum() + sum(m.v[i] @ m.v[j] for i in range(len(ids)) for j in range(i))
    assert abs(m.scorer()(text) - 1 / (1 + np.exp(-z))) < 1e-12 and abs(m.scorer()(b"") - 1 / (1 + np.exp(-m.bias))) < 1e-12


def test_every_term_of_the_fit_has_a_bucket():
    docs = [toxicity.hashed(f"only{i} shared".encode()) for i in range(50)]
    ids, _ = toxicity.batches_of(docs, np.zeros(50), np.arange(50))
    assert set(ids.tolist()) == {h for d in docs for h in d.tolist()} and ids.max() < toxicity.BUCKETS


def test_toxicity_on_awkward_rows(spark):
    d = H.docs(spark, extra=True)
    labels = spark.createDataFrame([(i, 1, int(i in (2, 11))) for i in range(1, 16)] + [(None, 1, 1), (3, 0, None)], LABELS)
    got = rows(toxicity.score(d, labels))
    assert len(got) == len(H.DOCS) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    kept = toxicity.drop_toxic(d, labels)
    assert kept.schema == d.schema and kept.count() == sum(r["predicted"] == 0 for r in got)
    assert toxicity.score(d.limit(0), labels).count() == 0 and {r["predicted"] for r in rows(toxicity.score(d, labels.limit(0)))} == {0}


def test_toxicity_is_fitted_in_a_task(spark, monkeypatch):
    texts = {i: " ".join([f"n{i % 7}", f"m{i % 5}"] + ["insult"] * (i % 3 == 0)) for i in range(60)}
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in texts], LABELS)
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    order = [r[0] for r in spark.createDataFrame([(i,) for i in texts], "doc_id long").orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    fit = [i for i in order if zlib.crc32(str(i).encode()) % 5][:40]
    want = toxicity.fit([toxicity.hashed(texts[i].encode()) for i in fit], np.array([float(i % 3 == 0) for i in fit]))

    def in_task(docs, y, fit=toxicity.fit):
        assert TaskContext.get(), "the driver holds the sets of all rows"
        return fit(docs, y)

    monkeypatch.setattr(toxicity, "fit", in_task)
    got = toxicity.train(d, labels, 40)
    assert got.bias == want.bias and all(np.array_equal(getattr(got, k), getattr(want, k)) for k in ("ids", "w", "v")) and len(want.ids)


def test_shrinking_by_slices(monkeypatch):
    r = np.random.default_rng(3)
    x, g = r.normal(0, 1, (50, 3)).astype(np.float32), r.random((50, 3)).astype(np.float32) + 1
    want = np.sign(x) * np.maximum(np.abs(x) - np.float64(0.3) / np.sqrt(g), 0)
    monkeypatch.setattr(toxicity, "SLICE", 7)
    assert np.array_equal(toxicity.shrunk(x, np.float64(0.3), g), want)


def test_toxicity_on_held_out_rows(spark):
    sf = SF_SMALL.replace("0.001", "0.1")
    got = {r["doc_id"]: r for r in rows(QUERIES["op3_toxicity"](spark, sf))}
    hits = Counter((r["toxic"], got[r["doc_id"]]["predicted"]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r["doc_id"]]["held_out"])
    assert hits[1, 1] >= 0.8 * (hits[1, 1] + hits[1, 0]) and hits[0, 1] <= 0.02 * (hits[0, 0] + hits[0, 1])


# ---- license scan ------------------------------------------------------------------------------------------------

def test_license_paragraphs(spark):
    got = rows(QUERIES["op5_license_scan"](spark, SF_SMALL))
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    want = {(i, p) for i, t in text.items() for p, line in enumerate(t.split("\n")) if "licens" in line.lower()}
    assert {(r["doc_id"], r["paragraph"]) for r in got} == want
    family = {"MIT": "MIT License", "Apache": "Apache", "GPL": "GNU General", "CC-BY-NC": "CC BY-NC"}
    assert all(family[r["family"]] in text[r["doc_id"]].split("\n")[r["paragraph"]] for r in got)


def test_license_awkward_rows(spark):
    near = "This project is licenced under the terms of the MIT License, see below."
    d = H.docs(spark, H.DOCS + [(20, near + "\nThe work of the public is free under the sun.\nLicensed under CC BY-SA 4.0.", "en", "a"), H.DOCS[-1]], extra=True)
    got = Counter((r["doc_id"], r["paragraph"], r["family"]) for r in rows(license_scan.scan(d)))
    assert got[15, 0, "MIT"] == 2 and got[20, 2, "CC-BY-SA"] == 1 and not [k for k in got if k[0] not in (15, 20) or k[:2] == (20, 1)]
    assert license_scan.scan(d.limit(0)).count() == 0


def test_wrapped_license_notices(spark):
    notices = [(f, t) for f, t in license_scan.TEMPLATES if f in ("MIT", "GPL", "BSD") and len(t) > 100]
    assert [f for f, _ in notices] == ["MIT", "GPL", "BSD"]
    data, want = [H.DOCS[-1], (None, "a\n\nb", "en", "a")], Counter({(15, 0, "MIT"): 1})
    for i, (f, t) in enumerate(notices):
        for j, (width, mark) in enumerate([(72, ""), (78, " * "), (40, "# "), (8, "")]):
            lines = [mark + x for x in textwrap.wrap(t, width, break_long_words=False)]
            data.append((100 * i + j + 100, "\n".join(["Some words first", "and more of them.", *lines, "Other words follow here.", "", "The end"]), "en", "a"))
            want[100 * i + j + 100, 2, f] = 1
    both = "\n".join("\n".join(textwrap.wrap(t, 75)) + "\n" for _, t in notices)
    data += [(900, both, "en", "a"), (901, "Permission is hereby granted, free of\n\ncharge, to any person obtaining a copy of this\n\nsoftware and associated", "en", "a")]
    at = [0] + [k + 1 for k, x in enumerate(both.split("\n")) if not x][:2]
    want.update((900, k, f) for k, (f, _) in zip(at, notices))
    got = Counter((r["doc_id"], r["paragraph"], r["family"]) for r in rows(license_scan.scan(H.docs(spark, data, extra=True))))
    assert got == want


def test_two_licenses_in_a_paragraph(spark):
    apache, mit = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License."
    data = [(1, f"{apache} {mit}", "en", "a"), (2, "Licensed under CC BY-NC 4.0.", "en", "a"), (3, "Licensed under CC BY 4.0. Licensed under CC BY-NC 4.0.", "en", "a"),
            (4, "This program is licensed under the GNU Affero General Public License, version 3.", "en", "a"),
            (5, " ".join(t for f, t in license_scan.TEMPLATES if f in ("BSD", "MPL", "MIT")), "en", "a")]
    got = Counter((r["doc_id"], r["paragraph"], r["family"]) for r in rows(license_scan.scan(H.docs(spark, data, extra=True))))
    assert got == Counter([(1, 0, "Apache"), (1, 0, "MIT"), (2, 0, "CC-BY-NC"), (3, 0, "CC-BY"), (3, 0, "CC-BY-NC"), (4, 0, "AGPL"), (5, 0, "BSD"), (5, 0, "MPL"), (5, 0, "MIT")])


# ---- secrets -----------------------------------------------------------------------------------------------------

def test_secret_spans(spark):
    d = H.docs(spark, extra=True)
    got = rows(secret_scan.scan(d))
    want = Counter()
    for i, t, *_ in H.DOCS:
        s = H.base_spans(t)
        n = Counter(k for k, *_ in s)
        want[i, n["assign"], n["access"], n["hex"], H.sha(",".join(f"{k}:{a}:{b}" for k, a, b in s).encode())] += 1
    assert Counter((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in got) == want
    eleven = next(r for r in got if r["doc_id"] == 11)
    assert "guess:6:16" in eleven["spans"] and eleven["n_guess"] == 1  # the placeholder after it is cheap to guess
    assert secret_scan.scan(d.limit(0)).count() == 0


def test_guess_costs_order_values():
    cost = secret_scan.guess_cost
    assert cost("") == 0 and cost("password") < cost("P@ssw0rd") < cost("changeme123") < cost("xK9!fQ2z") < cost("xK9!fQ2zL0pT")
    assert cost("aaaaaaaaaaaaaaaa") < 4 and cost("qwertyuiop") < 4 and cost("2019-05-17") < 6 and cost("abcabcabcabc") < 6
    assert cost("ab" * 20_000) < 10


def segment_costs(value):
    """The cheapest way to take each (start, end) as one segment, from the definitions."""
    S, low = secret_scan, value.lower()
    plain, out = low.translate(S.LOOKALIKE), {}

    def offer(i, j, c):
        out[i, j] = min(out.get((i, j), math.inf), c)

    for i in range(len(value)):
        for j in range(i + 1, len(value) + 1):
            part, n = value[i:j], j - i
            if n == 1:
                offer(i, j, S.DIGIT if part.isdigit() else S.LETTER + 0.3 * part.isupper() if part.isalpha() else S.JOINT if part in "_-." else S.OTHER)
            if plain[i:j] in S.RANK:
                offer(i, j, S.RANK[plain[i:j]] + S.SEGMENT + 0.3 * (part != low[i:j]) + 0.5 * (low[i:j] != plain[i:j]))
            for pattern, guesses in S.DATES:
                if pattern.fullmatch(part):
                    offer(i, j, S.SEGMENT + guesses)
            if n >= 3 and all(a + b in S.NEXT for a, b in zip(low[i:j], low[i + 1:j])):
                offer(i, j, S.SEGMENT + 1.5 + math.log10(n))
            for unit in range(1, S.UNIT + 1):
                if n >= 2 * unit and n % unit == 0 and part == part[:unit] * (n // unit):
                    offer(i, j, S.SEGMENT + unit * S.LETTER + math.log10(n // unit))
    return out


def test_guess_cost_is_the_least_of_all_segmentations():
    r = np.random.default_rng(11)
    parts = ["qwertyuiop", "password", "p4ssword", "2019", "2019-05-17", "17.05.2019", "abc", "aaaa", "abab", "xyzxyz", "Admin", "7", "Q", "!", "_", "poiu", "12345", "19990101"]
    values = ["".join(parts[k][int(r.integers(0, 3)):] for k in r.integers(0, len(parts), int(r.integers(1, 6)))) for _ in range(300)]
    values += ["".join("abAB12_"[k] for k in r.integers(0, 7, 14)) for _ in range(200)] + ["qwertyuiopassword", "ab" * 30 + "c", "aaaaaaaaaaaaab" * 3, "abcabdabcabd"]
    for value in values:
        segments, least = segment_costs(value), [0.0] + [math.inf] * len(value)
        for j in range(1, len(value) + 1):
            least[j] = min(least[i] + segments[i, j] for i in range(j) if (i, j) in segments)
        assert secret_scan.guess_cost(value) == pytest.approx(least[-1]), value
    assert secret_scan.guess_cost("qwertyuiopassword") < 3.5


def test_words_of_the_corpus_are_cheap_to_guess(spark):
    words = ["required", "disabled", "configuration", "everything"]
    prose = [(i, " ".join(words) + f" and more {i}", "en", "a") for i in range(5)]
    asked = [(10, "password: required", "en", "a"), (11, "secret = configuration", "en", "a"), (12, "pass: everything", "en", "a"), (13, "Authentication: disabled", "en", "a"),
             *[(20 + i, 'token = "zkqvxjwpyhgb"', "en", "a") for i in range(6)]]  # repeated values are no prose
    d = H.docs(spark, prose + asked)
    dictionary = secret_scan.corpus_words(d)
    assert set(words) <= set(dictionary) and "zkqvxjwpyhgb" not in dictionary and len(set(dictionary.values())) == len(dictionary)
    assert list(dictionary)[: len(secret_scan.RANK)] == list(secret_scan.RANK) and len(secret_scan.corpus_words(d, 2)) <= len(secret_scan.RANK) + 2
    assert {r["doc_id"] for r in rows(secret_scan.scan(d)) if r["n_guess"]} == {20 + i for i in range(6)}
    assert secret_scan.corpus_words(d.limit(0)) == secret_scan.RANK


@pytest.mark.parametrize("text,value", [
    ('aws_secret_access_key = "wJalrXUtnFEMIK7MDENGbPxRfiCY"', "wJalrXUtnFEMIK7MDENGbPxRfiCY"), ("DB_PASS=zR7!qLm2#vTx9", "zR7!qLm2#vTx9"),
    ("db_pwd: kX93-lmPQ-77zz", "kX93-lmPQ-77zz"), ('{"my_private_key": "Zk81qPw07xLs"}', "Zk81qPw07xLs"), ("DB_PASSWORD=zR7!qLm2#vTx9", "zR7!qLm2#vTx9"),
    ("Authorization: Bearer abcDEF93kQz81", "abcDEF93kQz81"), ("userPassword1 is zR7!qLm2#vTx9", "zR7!qLm2#vTx9"), ('client_secret: "q8W-z!71Lk"', "q8W-z!71Lk"),
    ("DB_PASS=changeme123", None), ("author: Schwarzenegger", None), ("the bearer certificates", None), ("tokenizer = BertWordPieceModel", None),
    ("the authorization is unconditional", None)])
def test_credential_words_inside_names(text, value):
    found = [text[a:b] for k, a, b in secret_scan.spans(text.encode())[0] if k == "guess"]
    assert found == [value] * (value is not None)


@pytest.mark.parametrize("text,value", [
    ('password = "p(9x,Kq!2vZr"', "p(9x,Kq!2vZr"), ('passphrase = "my dog ate it" # x', "my dog ate it"), ("'secret': 'a\"b;9 Kq{2}v', 'x': 'y'", 'a"b;9 Kq{2}v'),
    (r'pwd = "zR8\"kLm2Qp" + "x"', r'zR8\"kLm2Qp'), ('password = "zR8#kLm2Qp\nnext "line"', "zR8#kLm2Qp"), ("password = zR8#kLm2Qp, x", "zR8#kLm2Qp"),
    ('password = ""  # "zR8#kLm2Qp"', None), ('password = "your password here"', None)])
def test_quoted_credentials_are_whole(text, value):
    found = [text[a:b] for k, a, b in secret_scan.spans(text.encode())[0] if k == "guess"]
    assert found == [value] * (value is not None)


def test_many_credential_words_are_read_once():
    assert [k for k, *_ in secret_scan.spans(b"pass=" * 40_000)[0]] == ["guess"]  # one span holds the later names too


# ---- quality rules -----------------------------------------------------------------------------------------------

def test_quality_counts(spark):
    d = H.docs(spark, extra=True)
    labels = spark.createDataFrame([(i, int(i != 8), 0) for i in range(1, 16)] + [(None, 1, 1), (1, None, 0)], LABELS)
    got = rows(quality_rules.judge(d, labels))
    key = lambda r: (r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
    assert Counter(map(key, got)) == Counter((i, *H.quality_counts(t)) for i, t, *_ in H.DOCS)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and r["llr"] >= quality_rules.THRESHOLD)
    assert quality_rules.judge(d.limit(0), labels).count() == 0 and {r["llr"] for r in rows(quality_rules.judge(d, labels.limit(0)))} == {0.0}


def test_quality_keeps_trusted_and_drops_junk(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    got = {r["doc_id"]: r for r in rows(QUERIES["op8_quality_rules"](spark, sf))}
    q = Counter((r["quality"], got[r["doc_id"]]["kept"]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if not got[r["doc_id"]]["base_failed"])
    assert q[1, True] >= 0.98 * (q[1, True] + q[1, False]) and q[0, False] >= 0.9 * (q[0, True] + q[0, False])


# ---- SimHash -----------------------------------------------------------------------------------------------------

def test_simhash_equals_brute_force(spark):
    for rows_ in (H.DOCS, [(r["doc_id"], r["text"], "", "") for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]):
        got = rows(simhash.near_dedup(H.docs(spark, rows_, extra=True)))
        prints = [H.fingerprint(t) for _, t, *_ in rows_]
        least = defaultdict(list)
        roots = H.classes(prints)
        for (i, *_), root in zip(rows_, roots):
            least[root] += [i] if i is not None else []
        want = Counter((i, f"{p:016x}", min(least[r], default=None)) for (i, *_), p, r in zip(rows_, prints, roots))
        assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want


def test_vantage_point_shards_lose_no_link(monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 200)
    monkeypatch.setattr(simhash, "LEAF", 16)
    r = np.random.default_rng(5)
    x = [int(v) for v in r.integers(0, 2**63, 700)]
    for c in x[:60]:  # chains of near neighbours, and one crowded ball
        for _ in range(8):
            c ^= sum(1 << int(b) for b in r.choice(64, 4, replace=False))
            x.append(c)
    x += [x[0] ^ (1 << int(a)) ^ (1 << int(b)) for a, b in r.integers(0, 64, (500, 2))]
    x = np.unique(np.array(x, np.uint64))
    trees = simhash.plan_shards(x[r.permutation(len(x))[:600]], len(x))
    shards, block = defaultdict(list), {}
    for i, t in enumerate(trees):
        out = []
        simhash.route(t, x, np.ones(len(x), bool), out)
        assert sum(h.sum() for _, _, h in out) == len(x)  # one home each
        for s, f, h in out:
            shards[s].append((f, h))
            block[s] = i
    label, at = np.arange(len(x)), {int(v): i for i, v in enumerate(x)}
    assert len(shards) > 10
    for s, parts in shards.items():
        t = simhash.forest(pa.table({"shard": np.full(sum(len(f) for f, _ in parts), s), "fp": np.concatenate([f for f, _ in parts]).view(np.int64), "home": np.concatenate([h for _, h in parts])}), block)
        for u, v in zip(t["u"].to_numpy().view(np.uint64), t["v"].to_numpy().view(np.uint64)):
            simhash.unite(label, np.array([at[int(u)]]), np.array([at[int(v)]]))
    assert label.tolist() == H.classes(x)


def test_components_of_long_chains(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100 + i, 100) for i in range(1, 30)] + [(-5, -9), (7, -5)]
    got = {r["u"]: r["root"] for r in rows(simhash.components(spark.createDataFrame(edges, "u long, v long")))}
    assert got == {**{i: -9 for i in range(41)}, -5: -9, **{100 + i: 100 for i in range(1, 30)}}


def test_keep_first_of_each_component(spark):
    d = H.docs(spark, extra=True)
    out = simhash.keep_first(d)
    assert out.schema == d.schema
    ids = [r["doc_id"] for r in rows(out)]
    want = {r["component_id"] for r in rows(simhash.near_dedup(d))}
    assert len(ids) == len(set(ids)) and set(ids) == want
    assert simhash.keep_first(d.limit(0)).count() == 0 and simhash.near_dedup(d.limit(0)).count() == 0


# ---- language model ----------------------------------------------------------------------------------------------

@pytest.mark.parametrize("n,universe", [(0, 5), (1, 1 << 64), (3, 4), (1000, 1 << 50), (1000, 1001), (70_000, 1 << 63)])
def test_elias_fano_round_trip(n, universe):
    r = np.random.default_rng(n)
    v = np.unique(r.integers(0, universe, n, dtype=np.uint64))
    x = ngram_lm.EliasFano.at(ngram_lm.EliasFano.encode(v, universe))
    assert (x.get(np.arange(len(v))) == v).all()
    ask = np.concatenate((v, r.integers(0, universe, 500, dtype=np.uint64), np.array([0, universe - 1], np.uint64)))
    place = {int(k): i for i, k in enumerate(v)}
    assert x.find(ask).tolist() == [place.get(int(k), -1) for k in ask]
    part = x.find(ask, np.full(len(ask), n // 4), np.full(len(ask), n // 2))
    assert part.tolist() == [i if n // 4 <= (i := place.get(int(k), -1)) < n // 2 else -1 for k in ask]


@pytest.mark.parametrize("shard_tokens,batch_tokens", [(4_000_000, 2_000_000), (5000, 700)])
def test_language_model_equals_brute_force(spark, shard_tokens, batch_tokens):
    data = H.DOCS + [(100 + r["doc_id"], r["text"], "", "") for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").limit(80).collect()]
    data += [H.DOCS[7]] * 2
    d = H.docs(spark, data, extra=True)
    held = ngram_lm.held_out(d["doc_id"])
    model = ngram_lm.train(d.filter(~held), shard_tokens, batch_tokens)
    model.salts.update({0: 3})
    got = rows(ngram_lm.score(d, model, held, batch_tokens))
    tokens = [(i, i is not None and zlib.crc32(str(i).encode()) % 7 == 2, H.lower(t).split() + [b""]) for i, t, *_ in data]
    one, two = Counter(), Counter()
    for _, h, w in tokens:
        if not h:
            one.update(w)
            two.update(zip([w[-1], *w], w))
    n, k = sum(one.values()), sum(one.values()) + len(one) + 1
    eps = ngram_lm.BETA / n
    want = []
    for i, h, w in tokens:
        base = sum(math.log10((one[x] + 1) / k) for x in w)
        full = sum(math.log10((two[u, x] + eps * (one[x] + 1)) / (one[u] + eps * k)) for u, x in zip([w[-1], *w], w))
        want.append((str(i), h, len(w), sum(x in one for x in w), n, base, full))
    have = [(str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got]
    assert len(have) == len(want)
    for a, b in zip(sorted(have), sorted(want)):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-9) and abs(a[6] - b[6]) <= 0.02 * b[2], (a, b)


def test_language_model_cuts_a_heavy_word(spark):
    data = [(i, " ".join(x for j in range(400) for x in (f"c{(i * 400 + j) % 9000}", "the", "of")), "en", "a") for i in range(60)]
    d = H.docs(spark, data + H.DOCS, extra=True).repartition(4)
    held = ngram_lm.held_out(d["doc_id"])
    texts = d.filter(~held)
    n = ngram_lm.train(texts, 5000, 2000, cuts={}).n
    cut, whole = ngram_lm.train(texts, 5000, 2000, cuts={i: 5 for i in range(-(-n // 5000))}), ngram_lm.train(texts, 5000, 2000, cuts={})
    most = lambda m: m.trie.agg({"entries": "max"}).first()[0]
    assert (cut.n, cut.v, cut.shards) == (whole.n, whole.v, whole.shards) and most(cut) < most(whole) / 3
    assert cut.trie.agg({"entries": "sum"}).first()[0] == whole.trie.agg({"entries": "sum"}).first()[0]
    assert most(ngram_lm.train(texts, 1500, 2000)) < most(ngram_lm.train(texts, 1500, 2000, cuts={}))
    a, b = ({(str(r["doc_id"]), i): r for i, r in enumerate(sorted(rows(ngram_lm.score(d, m, held, 2000)), key=repr))} for m in (cut, whole))
    a, b = (sorted(((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in x.values())) for x in (a, b))
    assert len(a) == len(b) == len(data) + len(H.DOCS)
    for x, y in zip(a, b):
        assert x[:5] == y[:5] and math.isclose(x[5], y[5], rel_tol=1e-9, abs_tol=1e-9) and abs(x[6] - y[6]) <= 0.04 * x[2], (x, y)


def test_language_model_probabilities_sum_to_one():
    one, two = Counter("abac"), Counter(zip("cabac", "abac"))
    n, v, eps = 4, 3, 0.3
    for u in "abcx":
        total = sum((two[u, w] + eps * (one[w] + 1)) / (one[u] + eps * (n + v + 1)) for w in "abcx")
        assert math.isclose(total, 1)


def test_language_model_of_nothing(spark):
    d = H.docs(spark)
    assert ngram_lm.score_corpus(d.limit(0)).count() == 0
    got = rows(ngram_lm.score(d, ngram_lm.train(d.limit(0).select("text")), ngram_lm.held_out(d["doc_id"])))
    assert len(got) == len(H.DOCS) and {r["n_known"] for r in got} == {0} and {round(r["score"], 9) for r in got} == {0.0}
