"""Hard negatives, tokenizer alignment and personal data against brute force."""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from shopstrata.llm import alignment, hard_negatives, personal_data

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# ---- hard negatives -----------------------------------------------------------------------


def brute_negatives(rows):
    valid = [
        (i, lab, [int(x * 256 // 1) for x in v]) for i, v, lab in rows
        if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for q in sorted({i for i, _, _ in valid if i % 50 == 0}):
        label, own = min((lab, v) for i, lab, v in valid if i == q)
        scored = [
            (max(-(2**63) + 1, min(2**63 - 1, sum(a * b for a, b in zip(own, v, strict=True)))), i, lab == label)
            for i, lab, v in valid if i != q and len(v) == len(own)
        ]
        scored.sort(key=lambda x: (-x[0], x[1]))
        for p, pid in [(s, i) for s, i, same in scored if same][:5]:
            inside = [(s, i) for s, i, same in scored if not same and 50 * p <= 100 * s <= 95 * p][:3]
            out += [(q, pid, n + 1, i, p, s) for n, (s, i) in enumerate(inside)]
    return sorted(out)


@pytest.mark.parametrize("numbers", [1 << 23, 8])
def test_negatives(spark, numbers):
    r = np.random.default_rng(5)
    rows = [(i, [float(x) for x in r.normal(size=4) + 0.6], int(r.integers(3))) for i in range(300)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5], 1) for i in range(300, 380)]  # a frequent vector and label
    rows += [(7, rows[7][1], rows[7][2]), (100, rows[100][1], rows[100][2]), (100, rows[101][1], 2), (None, [1.0] * 4, 1)]
    rows += [(400, None, 1), (401, [1.0, None, 1.0, 1.0], 1), (402, [float("nan")] * 4, 1), (403, [float("inf")] * 4, 1)]
    rows += [(450, [1.0, 2.0], 0), (451, [1.0, 2.0], 0), (452, [0.9, 1.5], 1), (453, [], 0), (500, [1.0] * 4, None)]
    rows += [(550, [0.0] * 4, 0), (551, [-1.0] * 4, 2), (552, [3e5, 1.0, 0.0, 2.0], 2), (553, [1e30, 0.0, 0.0, 0.0], 0)]
    rows += [(600, [3e5, 3e5, 1.0, 1.0], 0), (601, [2.9e5, 2.8e5, 1.0, 1.0], 1), (650, [1e30, 0.0, 0.0, 1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    df = df.selectExpr("*", "1 anchor", "2 score", "3 slot", "4 at").repartition(5)
    found = hard_negatives.mine(df, F.col("vec_id") % 50 == 0, block_numbers=numbers)
    assert sorted(tuple(x) for x in found.collect()) == brute_negatives(rows)
    assert hard_negatives.mine(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []


# ---- alignment ----------------------------------------------------------------------------


def brute_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)
    vocabulary = {i: t for t, i in json.loads(open(A).read())["model"]["vocab"].items()}
    back = {c: b for b, c in enumerate(alignment.stand_ins())}

    def piece(i):
        name = pieces.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", name) else name.replace("▁", " ").encode()

    rows, total = [], Counter()
    for text in texts:
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        raw = [bytes(back[c] for c in vocabulary[i]) for i in a], [piece(i) for i in b]
        if not text or any(b"".join(x) != (" " + text).encode() for x in raw):
            rows.append(None)
            continue
        ends = [list(itertools.accumulate(map(len, x))) for x in raw]
        links, i, j = [], 0, 0
        while i < len(a):
            links.append((a[i], b[j]))
            ei, ej = ends[0][i], ends[1][j]
            i, j = i + (ei <= ej), j + (ej <= ei)
        total.update(links)
        common = sorted(set(ends[0]) & set(ends[1]))
        groups, i, j = [], 0, 0
        for c in common:
            k, m = ends[0].index(c, i) + 1, ends[1].index(c, j) + 1
            groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
            i, j = k, m
        rows.append((a, b, groups, links))
    best = {}
    for (_, y), n in total.items():
        best[y] = max(n, best.get(y, 0))
    return [
        (0, 0, 0, 0, 0, 0, "") if r is None else (
            len(r[0]), len(r[1]), len(r[2]), len(r[3]), sum(total[x] == best[x[1]] for x in r[3]), sum(total[x] for x in r[3]),
            hashlib.sha256(";".join(r[2]).encode()).hexdigest(),
        )
        for r in rows
    ]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def by_row(found):
    return sorted([(r.doc_id is None, r.doc_id or 0, *(r[c] for c in COLUMNS)) for r in found.collect()])


@pytest.mark.parametrize("together", [16_000_000, 200])
def test_alignment(spark, odd, odd_rows, together, monkeypatch):
    monkeypatch.setattr(alignment, "STEP_BYTES", 4000)
    more = ["a ▁ mark", "<s> </s> <unk> <0x41>", " lead  and   trail   ", "tab\t and\r\n line   wide space", "  ", "\x1c x \x85 y"]
    rows = [*odd_rows, *((100 + i, t, "en", "s", 0) for i, t in enumerate(more))]
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(more)], "doc_id long, text string")
    docs = odd.unionByName(extra, allowMissingColumns=True).withColumn("origin", F.lit(1)).withColumn("nth", F.lit(2))
    found = by_row(alignment.align(docs.repartition(3), A, B, together))
    want = [(r[0] is None, r[0] or 0, *w) for r, w in zip(rows, brute_alignment([r[1] or "" for r in rows]), strict=True)]
    assert found == sorted(want)


def test_alignment_of_given_texts_and_of_none(spark, docs, no_docs):
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = [(i is None, i or 0, *w) for (i, _), w in zip(texts, brute_alignment([t or "" for _, t in texts]), strict=True)]
    assert by_row(alignment.align(docs, A, B)) == sorted(want)
    assert alignment.align(no_docs, A, B).collect() == []


def test_runs_are_merged_in_order():
    r = np.random.default_rng(0)
    want, headers = Counter(), []
    for _ in range(5):
        codes = np.sort(r.integers(0, 50, 200)) << alignment.A_BITS
        want.update(codes.tolist())
        headers += [header for _, _, header, _ in alignment.runs(codes, r.integers(0, 9, 200))]
    assert list(alignment.merged(headers)) == sorted(want.items())


# ---- personal data ------------------------------------------------------------------------

EXPRESSIONS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_base(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(d[::-1])) % 10 == 0

    passes = {
        "email": lambda m: True, "ip": lambda m: all(int(x) <= 255 for x in m.group().split(".")),
        "card": lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m)), "phone": lambda m: 8 <= len(digits(m)) <= 15,
    }
    return [f"{k}:{m.start()}:{m.end()}" for k, e in EXPRESSIONS.items() for m in re.finditer(e, text) if passes[k](m)]


ODD = [
    "a@b.c@d.e x@y..z @q.r a@b@c.de 1.2.3.4.5.6.7.8.9 1..2.3.4.5 256.1.1.1 001.002.003.004 1.2.3 .1.2.3.4. 999999.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1111-5 4111  1111 1111 1111 +1 (555) 123-4567. +1 2 +49-(0)30.1234567- ++12345678 +123456789012345678",
    "ünï é@x.yz 日本 127.0.0.1日 a.b%c+d@e-f.g-h.i tail@",
]


def test_base_spans_match_the_expressions():
    r = np.random.default_rng(3)
    texts = ODD + ["".join(r.choice(list("0123456789.@+-() ab"), 80, p=[0.05] * 10 + [0.1, 0.08, 0.04, 0.06, 0.02, 0.02, 0.1, 0.04, 0.04])) for _ in range(4000)]
    for text in texts:
        base, _ = personal_data.scan(text)
        assert [s.text() for s in base] == brute_base(text), text


def kinds(text):
    return [(s.kind, text[s.start : s.end]) for s in personal_data.scan(text)[1]]


def test_added_spans_need_their_checks_and_context():
    assert kinds("IBAN GB82 WEST 1234 5698 7654 32 THEN") == [("iban", "GB82 WEST 1234 5698 7654 32")]
    assert kinds("pay to DE89370400440532013000, CODE") == [("iban", "DE89370400440532013000")]
    assert kinds("account ES91 2100 0418 4502 0005 1332 CODE") == [("iban", "ES91 2100 0418 4502 0005 1332")]
    assert kinds("GB82 WEST 1234 5698 7654 33") == []  # the check digits do not hold
    assert kinds("amex card 3782 822463 10005") == [("card_short", "3782 822463 10005")]
    assert kinds("3782 822463 10005") == [] and kinds("amex card 3782 822463 10006") == []
    assert kinds("ssn 123-45-6789") == [("ssn", "123-45-6789")]
    assert kinds("123-45-6789") == [] and kinds("ssn 666-45-6789") == [] and kinds("ssn 123-45-67890") == []
    assert kinds("reach (499) 555-6503 now") == [("phone_local", "(499) 555-6503")]
    assert kinds("order (499) 555-6503") == [] and kinds("call 499-555-6503") == [("phone_local", "499-555-6503")]
    assert kinds("499-555-6503 it is") == [] and kinds("ssn 123-45-6789@example.com") == []  # part of a base span


def test_long_texts_take_time_in_proportion():
    for unit in ("x", "1", "1.", "@", "a@", "+1(", "1 ", "A", "(", "DE12 "):
        personal_data.scan(unit * (1_000_000 // len(unit)))


def test_personal_data_of_rows(spark, odd, odd_rows, no_docs):
    found = personal_data.find(odd).collect()
    assert len(found) == len(odd_rows)
    given = Counter((r[0], ",".join(brute_base(r[1] or ""))) for r in odd_rows)
    assert Counter((r.doc_id, ",".join(s for s in r.spans.split(",") if s.split(":")[0] in personal_data.BASE)) for r in found) == given
    extra = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    for r in personal_data.find(extra).collect():
        base = brute_base(ODD[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k + ":") for s in base) for k in personal_data.BASE]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert len(r.scores.split(",")) == len(r.spans.split(","))
    assert personal_data.find(no_docs).collect() == []
