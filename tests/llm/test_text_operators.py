"""Language, packing, codec, quality, SimHash, substrings and licenses against plain Python."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import xxhash

from shopstrata.llm import bpe_codec, language_id, licenses, outliers, packing, simhash, substrings
from shopstrata.llm.components import components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# ---- language -----------------------------------------------------------------------------


def test_language_on_held_out_documents(docs):
    found = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in found if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_language_switches_inside_a_line(docs):
    model = language_id.fit(language_id.sample(docs))
    texts = {r.lang: r.text for r in docs.where("length(text) > 600").dropDuplicates(["lang"]).collect()}
    a, b = sorted(texts)[:2]
    mixed = " ".join(texts[a].split()[:60]) + " " + " ".join(texts[b].split()[:25])
    label, score = model.predict([mixed])[0]
    assert label == a and 0.5 < score < 0.9


def test_language_of_odd_rows(odd, no_docs, odd_rows):
    found = rows_of(language_id.identify(odd))
    assert len(found) == len(odd_rows)
    by_text = {(i, t): None for i, t, *_ in odd_rows}
    lettered = sum(bool(t and re.search(r"[^\W\d_]", t)) for _, t, *_ in odd_rows)
    assert sum(label != "und" for _, _, label, _ in found) == lettered and by_text
    assert rows_of(language_id.identify(no_docs)) == []


def test_marginals_equal_enumeration():
    r = np.random.default_rng(3)
    emitted, moves, start = r.normal(size=(5, 2)), r.normal(size=(2, 2)), r.normal(size=2)
    sizes = np.array([2, 3])
    gamma, _, _ = language_id.marginals(emitted, moves, start, language_id.Lattice.of(np.array([0, 2]), sizes))
    for begin, n in ((0, 2), (2, 3)):
        mass = np.zeros((n, 2))
        for code in range(2**n):
            path = [code >> k & 1 for k in range(n)]
            score = start[path[0]] + sum(emitted[begin + k, path[k]] for k in range(n))
            score += sum(moves[path[k], path[k + 1]] for k in range(n - 1))
            for k in range(n):
                mass[k, path[k]] += np.exp(score)
        assert np.allclose(gamma[begin : begin + n], mass / mass.sum(axis=1, keepdims=True))


# ---- packing and codec --------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def check_packing(found, source, tokenizer, capacity):
    expected = Counter()
    for doc_id, text in source:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        at, k, size = 0, 0, len(ids) % capacity or capacity
        while at < len(ids):
            part = ids[at : at + size]
            expected[doc_id, k, at, size, zlib.crc32(struct.pack(f"<{size}I", *part))] += 1
            at, k, size = at + size, k + 1, capacity
    assert Counter(r[:5] for r in found) == expected
    ends: dict = {}
    for r in sorted(found, key=lambda r: (r[5], r[6])):
        assert ends.get(r[5], 0) == r[6]
        ends[r[5]] = r[6] + r[3]
    assert max(ends.values(), default=0) <= capacity
    return ends


def test_packing(docs, tokenizer):
    found = rows_of(packing.pack(docs, P.path("byte_bpe_50k.json")))
    ends = check_packing(found, [(r.doc_id, r.text) for r in docs.collect()], tokenizer, 2048)
    assert len(ends) <= -(-sum(ends.values()) // 2048) * 1.02 + 1


@pytest.mark.parametrize("capacity", [2048, 16])
def test_packing_of_odd_rows(odd, no_docs, odd_rows, tokenizer, capacity):
    found = rows_of(packing.pack(odd, P.path("byte_bpe_50k.json"), capacity))
    check_packing(found, [r[:2] for r in odd_rows], tokenizer, capacity)
    assert rows_of(packing.pack(no_docs, P.path("byte_bpe_50k.json"))) == []


def test_plan_places_every_rank_once():
    r = np.random.default_rng(5)
    counts = {int(k): int(n) for k, n in zip(r.integers(1, 101, 60), r.integers(1, 5000, 60), strict=True)}
    slots = packing.plan(counts, 100)
    ranks: dict = {}
    used: Counter = Counter()
    for length, first, n, sequence, _ in slots:
        ranks.setdefault(length, []).append((first, first + n))
        for s in range(sequence, sequence + n):
            used[s] += length
    for length, spans in ranks.items():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] == counts[length]
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert max(used.values()) <= 100
    # no plan has fewer sequences than the whole needs, or than there are pieces over half a sequence
    least = max(sum(k * v for k, v in counts.items()) / 100, sum(v for k, v in counts.items() if k > 50))
    # the proven bound of best-fit decreasing
    assert len(used) <= least * 11 / 9 + 1


def test_ranks_without_hot_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", 10)
    rows = spark.range(500).selectExpr("id doc_id", "0 piece", "cast(id % 2 as bigint) length", "id ids_crc32")
    found = packing.ranked(rows, {0: 250, 1: 250}).collect()
    for k in (0, 1):
        assert sorted(r["rank"] for r in found if r["length"] == k) == list(range(250))


def test_codec(docs, odd, odd_rows, no_docs):
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for df, source in ((docs, [(r.doc_id, r.text) for r in docs.collect()]), (odd, [r[:2] for r in odd_rows])):
        expected = Counter()
        for doc_id, text in source:
            ids = encoding.encode_ordinary(text or "")
            raw = struct.pack(f"<{len(ids)}I", *ids)
            whole = (text or "").encode()
            expected[doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(whole).hexdigest()] += 1
        assert Counter(rows_of(bpe_codec.round_trip(df, path, P.PATTERN))) == expected
    assert rows_of(bpe_codec.round_trip(no_docs, path, P.PATTERN)) == []


# ---- quality ------------------------------------------------------------------------------


def base_counts(text):
    words = WORDS.findall(text or "")
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {k + j for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_quality_counts(docs, odd, odd_rows, no_docs):
    for df, source in ((docs, [(r.doc_id, r.text) for r in docs.collect()]), (odd, [r[:2] for r in odd_rows])):
        found = outliers.judge(df).collect()
        assert Counter((r.doc_id, *(r[c] for c in COUNTS)) for r in found) == Counter(
            (i, *base_counts(t)) for i, t in source
        )
        assert not any(r.kept and r.base_failed for r in found)
    assert rows_of(outliers.judge(no_docs)) == []


def brute_mcd(x):
    """The same estimator on one group's matrix."""
    def estimate(y):
        m = y.mean(axis=0)
        c = y.T @ y / len(y) - np.outer(m, m) + np.eye(5) * outliers.FLOOR
        return m, c

    def distances(x, state):
        d = x - state[0]
        return np.einsum("ij,jk,ik->i", d, np.linalg.inv(state[1]), d)

    m, s = x.mean(axis=0), np.sqrt(np.maximum(x.var(axis=0), outliers.FLOOR))
    found = []
    for start in (x, np.clip(x, np.floor(m - 1.5 * s), np.ceil(m + 1.5 * s))):
        state = estimate(start)
        for _ in range(outliers.STEPS):
            bins = np.floor(np.log(distances(x, state) + 1e-6) * outliers.BINS_PER_UNIT)
            edge = np.sort(bins)[int(np.ceil(outliers.SHARE * len(x))) - 1]
            state = estimate(x[bins <= edge])
        found.append((np.linalg.slogdet(state[1])[1], state))
    return distances(x, min(found, key=lambda f: f[0])[1]) / outliers.consistency(outliers.SHARE, 5)


def test_quality_distances_equal_a_matrix_computation(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("source", F.lit("one"))
    counted = outliers.statistics(docs).where("NOT base_failed")
    x = {r.doc_id: r for r in counted.select("doc_id", "lang", *outliers.transformed()).collect()}
    found = {r.doc_id: r.distance for r in outliers.judge(docs).collect() if r.distance is not None}
    assert found.keys() == x.keys()
    for lang in {r.lang for r in x.values()}:
        own = [i for i, r in x.items() if r.lang == lang]
        if len(own) >= outliers.LEAST_GROUP:
            expected = brute_mcd(np.array([x[i][2:] for i in own], float))
            assert np.allclose([found[i] for i in own], expected, rtol=1e-6, atol=1e-9)


def test_quality_rejects_junk_and_keeps_clean(spark):
    sf = "/root/testdata/sf0.01"
    judged = outliers.judge(spark.read.parquet(f"{sf}/documents.parquet")).where("NOT base_failed")
    pairs = judged.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert sum(r.kept for r in pairs if r.quality == 1) / sum(r.quality == 1 for r in pairs) > 0.99
    assert sum(not r.kept for r in pairs if r.quality == 0) / max(1, sum(r.quality == 0 for r in pairs)) > 0.9


def test_every_statistic_rejects_by_itself(spark):
    r = np.random.default_rng(4)

    def words(n, letters=6):
        return ["".join(w) for w in r.choice(list("abcdefghijklmnopqrstuvwxyz"), (n, letters))]

    inner = [" ".join(words(int(n))) for n in r.integers(80, 120, 300)]
    few, order = words(5), [0, 0, 0]
    seen = {(0, 0, 0)}
    while len(order) < 100:  # no three lines in a row come twice
        fresh = [k for k in range(4, -1, -1) if (*order[-2:], k) not in seen]
        order.append(fresh[0])
        seen.add(tuple(order[-3:]))
    odd = {
        "length": " ".join(words(20_000)),
        "word_length": " ".join(words(100, 60)),
        "symbols": " ".join(["#####" + w for w in words(100)]),
        "dup_lines": "\n".join(few[k] for k in order),
        "repeats": " ".join(words(52) + words(8) * 6),
    }
    rows = [(i, t, "en", "s") for i, t in enumerate([*inner, *odd.values()])]
    found = {x.doc_id: x for x in outliers.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert sum(found[i].kept for i in range(300)) > 295
    last = dict(zip(odd, (found[300 + k] for k in range(5)), strict=True))
    assert not any(x.base_failed or x.kept for x in last.values()), last
    assert last["dup_lines"].n_repeat_words == 0 and last["repeats"].n_dup_lines == 0


def test_chi_square():
    assert abs(outliers.chi_square(11.0705, 5) - 0.95) < 1e-5
    assert abs(outliers.chi_square_cutoff(0.05, 5) - 11.0705) < 1e-3


# ---- SimHash ------------------------------------------------------------------------------


def brute_fingerprint(text):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints):
    """prints: id -> fingerprint."""
    ids, parent = sorted(prints), {}
    for i in ids:
        parent[i] = i

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in ids}


def test_simhash(docs):
    prints = {r.doc_id: brute_fingerprint(r.text) for r in docs.collect()}
    classes = brute_classes(prints)
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert found == {i: (f"{p:016x}", classes[i]) for i, p in prints.items()}


def test_simhash_of_odd_rows(odd, odd_rows, no_docs):
    found = simhash.near_duplicates(odd).collect()
    assert Counter((r.doc_id, r.fingerprint) for r in found) == Counter(
        (i, f"{brute_fingerprint(t):016x}") for i, t, *_ in odd_rows
    )
    assert {r.component_id for r in found if r.fingerprint == "0" * 16} == {0}
    assert rows_of(simhash.near_duplicates(no_docs)) == []


@pytest.mark.parametrize("cell_pairs", [1, 64])
def test_links_hold_in_full_cells(spark, cell_pairs):
    r = np.random.default_rng(8)
    centre = int(r.integers(0, 1 << 62))
    near = {centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in r.integers(0, 63, (150, 2))}
    far = {int(x) for x in r.integers(0, 1 << 62, 100)}
    prints = {i: p for i, p in enumerate(sorted(near | far | {centre}))}
    nodes = spark.createDataFrame([(p, i) for i, p in prints.items()], "fp long, node long")
    found = components(simhash.links(nodes, cell_pairs=cell_pairs))
    mine = {i: i for i in prints} | {r.node: r.component for r in found.collect()}
    assert mine == brute_classes(prints)


def test_links_hold_in_a_full_cell_among_small_ones(spark):
    r = np.random.default_rng(9)
    by_count = {n: [b for b in range(16) if b.bit_count() == n] for n in range(5)}

    def of(counts):
        parts = [by_count[n] for n in counts]
        parts[15] = [b for b in parts[15] if b < 8]
        return sum(int(r.choice(p)) << 4 * s for s, p in enumerate(parts))

    own = [2] * 16
    first = of(own) & ~15 | 0b0011
    second = first & ~15 | 0b0101  # one bit up, one down in segment 0
    around = {of([n + (s == at) * (-1) ** k for s, n in enumerate(own)]) for at in range(1, 15) for k in range(6)}
    prints = {i: p for i, p in enumerate(sorted({first, second} | around))}
    nodes = spark.createDataFrame([(p, i) for i, p in prints.items()], "fp long, node long")
    sizes = {r["cell"]: r["count"] for r in simhash.cells(nodes).groupBy("cell").count().collect()}
    shared = sum(2 << 3 * s for s in range(16))
    assert sizes[shared] > simhash.CELL_PAIRS and sizes[shared + 1] == sizes[shared - 1] == 2
    mine = {i: i for i in prints} | {r.node: r.component for r in components(simhash.links(nodes)).collect()}
    assert mine == brute_classes(prints) and len(set(mine.values())) < len(prints)


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001), (5, 5), (None, 3)]
    found = dict(rows_of(components(spark.createDataFrame(edges, "a long, b long"))))
    assert found == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}
    assert rows_of(components(spark.createDataFrame([], "a long, b long"))) == []


# ---- language: letters ---------------------------------------------------------------------


def test_signs_that_only_count_are_no_letters():
    assert language_id.words_of("½ ² ① Ⅷ x² ½ß 3rd") == ["x²", "½ß", "rd"]
    model = language_id.fit([("de", "der die das und"), ("en", "the and of to")])
    assert [p[0] for p in model.predict(["½ ² ①", "Ⅷ", "the of"])] == ["und", "und", "en"]


# ---- substrings ---------------------------------------------------------------------------


def brute_kept(rows, window=13):
    least: dict = {}
    for i, text, *_ in rows:
        words = WORDS.findall(text or "")
        for k in range(len(words) - window + 1):
            key = tuple(words[k : k + window])
            if i is not None:
                least[key] = min(least.get(key, i), i)
    out = Counter()
    for i, text, *_ in rows:
        words = WORDS.findall(text or "")
        gone = set()
        for k in range(len(words) - window + 1):
            if i is not None and least[tuple(words[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out[i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("seen", [1, 10**9])
def test_substrings_of_odd_rows(odd, odd_rows, no_docs, seen, monkeypatch):
    monkeypatch.setattr(substrings, "SAMPLED", 1)
    found = Counter(rows_of(substrings.removal_digest(odd, seen=seen)))
    assert found == brute_kept(odd_rows)
    assert rows_of(substrings.removal_digest(no_docs, seen=seen)) == []


def test_heavy_way_equals_light_way(docs, monkeypatch):
    monkeypatch.setattr(substrings, "SAMPLED", 1)
    light, heavy = substrings.removal_digest(docs, most=0), substrings.removal_digest(docs, seen=2)
    assert len(substrings.heavy_minimisers(substrings._binary(docs), 13, 2)) > 10
    assert Counter(rows_of(light)) == Counter(rows_of(heavy)) == brute_kept([(r.doc_id, r.text) for r in docs.collect()])


def test_word_codes_see_words_only():
    a, _ = substrings.word_codes(b"one two  three")
    b, starts = substrings.word_codes(b"x" * 70_000 + b"\tone \n two\x0bthree ")
    assert (a == b[1:]).all() and starts.tolist() == [0, 70_001, 70_007, 70_011]


# ---- licenses -----------------------------------------------------------------------------


def brute_licenses(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = pattern.findall(text)
    places, base = [], set()
    for phrase, label in licenses.PHRASES.items():
        own = phrase.split()
        for k in range(len(words) - len(own) + 1):
            if words[k : k + len(own)] == own:
                places.append(k)
                base.add(label)
    extra, best = set(), 0.0
    for line in text.split("\n"):
        found = pattern.findall(line)
        last = max(0, len(found) - 64)
        for at in [*range(0, last, 32), last]:
            block = set(found[at : at + 64])
            for label, template in licenses.TEMPLATES.items():
                own, telling = set(template.split()), set(licenses.TELLING.get(label, "").split())
                if len(own & block) >= 0.8 * len(own) - 1e-9 and telling <= block:
                    extra.add(label)
                    best = max(best, len(own & block) / len(own))
    first, last = (min(places), max(places)) if places else (None, None)
    labels = ",".join(sorted(base | extra))
    return len(words), len(places), first, last, ",".join(sorted(base)), labels, 1.0 if base else best


def test_licenses(docs, odd, odd_rows, no_docs):
    for df, source in ((docs, [(r.doc_id, r.text) for r in docs.collect()]), (odd, [r[:2] for r in odd_rows])):
        assert Counter(rows_of(licenses.scan(df))) == Counter((i, *brute_licenses(t)) for i, t in source)
    assert rows_of(licenses.scan(no_docs)) == []


def test_license_join_finds_all_templates(spark):
    rows = [(i, f"Foo bar. {t}; 2020", "", "", 0) for i, t in enumerate(licenses.TEMPLATES.values())]
    rows.append((99, "z " * 500 + licenses.TEMPLATES["bsd"] + " z" * 500, "", "", 0))
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, a string, b string, c int")).collect()}
    for i, label in enumerate(licenses.TEMPLATES):
        assert label in found[i].labels.split(",") and found[i].score == 1.0
    assert "bsd" in found[99].labels


def license_labels(text, templates=licenses.TEMPLATES):
    index = licenses.Index.of(templates, {}, licenses.THRESHOLD)
    return set(licenses.scan_text(text.encode(), index, [], list(index.by_word))[5].split(","))


@pytest.mark.parametrize("label", ["apache-2.0", "bsd", "mit-text", "isc", "gpl-3.0"])
def test_licenses_wrapped_over_lines(label):
    words = licenses.TEMPLATES[label].split()
    half = len(words) // 2
    wrapped = "z " * 70 + "\n" + " ".join(words[:half]) + "\n" + " ".join(words[half:]) + "\n" + "z " * 70
    assert license_labels(wrapped) == {label}


def test_licenses_of_one_block():
    both = "Code is released under the MIT license, data licensed under the Apache License version 2.0"
    assert license_labels(both) == {"mit", "apache-2.0"}
    assert license_labels("Licensed under CC BY-SA 4.0") == {"cc-by-sa-4.0", "cc-by-4.0"}  # it holds all of cc-by's words
    assert license_labels("Licensed under CC BY 4.0") == {"cc-by-4.0"}


def test_notices_without_their_telling_words_are_none():
    assert license_labels("This software is released under the Apache license") == {""}
    assert license_labels("It was released under pressure. Later the driver license was lost.") == {""}
    assert license_labels("This work is licensed under the GNU General Public License version 3") == {"gpl-3.0"}
    assert license_labels("Licensed under the GNU Lesser General Public License version 3") >= {"lgpl"}
