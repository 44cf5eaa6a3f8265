"""Secret scan: patterns against a plain scanner, the battery and its control against plain Python."""

import hashlib
import math
import random
import re
import string

import numpy as np
import pytest

from rarebird.llm import queries, secret_scan

SF = "/root/testdata/sf0.001"


def brute_base(text):
    """(start, kind, end) by scanning with the patterns as the definition has them."""
    out = []
    names = re.compile("(?ai)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    for kind, pattern, enough in [(0, names, lambda m: len(m[2]) >= 12), (1, re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
                                  (2, re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 16)]:
        out += [(m.start(), kind, m.end()) for m in pattern.finditer(text or "") if enough(m)]
    return sorted(out)


def joined(spans):
    return ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def brute_battery(token):
    """Encoding number, equal pairs and p-value of one token, symbol by symbol."""
    number, alphabet = next((k, a) for k, a in enumerate(secret_scan.ENCODINGS.values()) if set(token) <= set(a))
    n, size, values = len(token), len(alphabet), [alphabet.index(c) for c in token]
    pairs = sum(values[i] == values[j] for i in range(n) for j in range(i))
    chi2 = sum((values.count(v) - n / size) ** 2 / (n / size) for v in range(size))
    var = 2 / (9 * (size - 1))
    zs = [((chi2 / (size - 1)) ** (1 / 3) - (1 - var)) / math.sqrt(var)]
    high = [v >= size / 2 for v in values]
    mean = 2 * sum(high) * (n - sum(high)) / n
    changes = sum(a != b for a, b in zip(high, high[1:]))
    zs.append((changes - mean) / math.sqrt(max(mean * (mean - 1) / (n - 1), 1e-12)) if mean > 1 else math.inf)
    mu = sum(values) / n
    power = sum((v - mu) ** 2 for v in values)
    zs.append((sum((a - mu) * (b - mu) for a, b in zip(values, values[1:])) / power + 1 / n) * math.sqrt(n) if power else math.inf)
    return number, pairs, min(1.0, 3 * math.erfc(max(map(abs, zs)) / math.sqrt(2)))


def random_text(rnd, alphabet, n):
    return "".join(rnd.choice(alphabet) for _ in range(n))


def cases():
    rnd = random.Random(5)
    h = "0123456789abcdef"
    return [None, "", " \n", "password=short", "password=abcdefghijkl", "My PassWord : 'abcdefghijkl' é", "ü" * 9 + " api_key\":\"abc.def/ghi=jkl\" x",
            "tokentoken=abcdefghijklmnop", "ſecret=abcdefghijklmn toKen=abcdefghijklm", "secret = = abcdefghijklmnop", "token:\nabcdefghijklmnop",
            "AKIA" + "A" * 13, "AKIA" + "A" * 14, "AKIAAKIA" + "B" * 12, "xAKIA" + "1" * 20 + "a", "XXAKIA" + "Z" * 14 + "AKIA", "AKIA" * 6,
            "g" + h[:15], "é" + h + "g", h * 4 + "G" + h[:3] + " " + h[::-1], "apikey=" + h + h, random_text(rnd, string.ascii_letters + string.digits + "+/", 40),
            "aaaaaaaaaaaaaaaaaaaaaaaa", "/usr/share/some-long_path/and/more", "0" * 30, "ab" * 20, string.ascii_uppercase + string.ascii_lowercase]


def test_base_spans_match_a_plain_scan(spark, texts):
    rows = list(enumerate([*cases(), *texts.values(), "word " * 50000 + "token=abcdefghijklmnop"]))
    got = secret_scan.find_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    for r in got:
        text = rows[r.doc_id][1] or ""
        base = brute_base(text)
        assert [tuple(s) for s in r.base] == base, r.doc_id
        runs = [(m.start(), m.end()) for m in re.finditer("[A-Za-z0-9+/_-]{16,}", text)]
        free = [(s, e) for s, e in runs if not any(a <= s and e <= b for a, _, b in base)]
        assert [(t.start, t.end) for t in r.tokens] == free
        for t in r.tokens:
            number, pairs, p = brute_battery(text[t.start : t.end])
            assert (t.encoding, t.pairs, t.length) == (number, pairs, t.end - t.start)
            assert t.p == pytest.approx(p, rel=1e-6, abs=1e-12)


def test_random_tokens_pass_and_even_ones_do_not():
    rnd = random.Random(11)

    def p_of(tokens):
        data = np.frombuffer("".join(tokens).encode(), np.uint8)
        ends = np.cumsum([len(t) for t in tokens])
        return secret_scan.battery(data, ends - [len(t) for t in tokens], ends)[2]

    alphabet = string.ascii_letters + string.digits + "+/"
    assert np.mean(p_of([random_text(rnd, alphabet, 40) for _ in range(2000)]) < secret_scan.RANDOM_P) < 0.03
    assert (p_of(["ab" * 20, "a" * 40, "0123456789" * 4, alphabet, "aaaaaaaaaaaaaaaaaaaabbbbbbbbbbbbbbbbbbbbbb"]) < secret_scan.RANDOM_P).all()


def test_limits_are_benjamini_hochberg():
    rnd = random.Random(2)
    rows = [(s, rnd.randrange(-600, 300), rnd.randrange(1, 5)) for s in (1, 2) for _ in range(200)] + [(3, 250, 9), (4, secret_scan._FAR, 5)]
    got = secret_scan.limits(rows)
    for s in (1, 2):
        ps = sorted((0.5 * math.erfc(-step / 100 / math.sqrt(2)), step) for t, step, n in rows if t == s for _ in range(n))
        ok = [step for k, (p, step) in enumerate(ps) if p <= 0.05 * (k + 1) / len(ps)]
        assert got[s] == max(ok)
    assert set(got) == {1, 2}


def test_planted_secrets_are_found_and_ordinary_tokens_are_not(spark, texts):
    rnd = random.Random(7)
    alphabet = string.ascii_letters + string.digits + "+/"
    keys = {k: random_text(rnd, alphabet, 44) for k in range(60)}
    plain = {k: f"see /docs/{w}/some-long_path-to-a-page and internationalisation_of_words {w}" for k, w in
             enumerate(w for t in texts.values() for w in re.findall("[a-z]{5,}", t)[:1])}
    rows = [(k, f"the value {v} is here") for k, v in keys.items()] + [(1000 + k, t) for k, t in plain.items()]
    rows += [(5000 + k, t) for k, t in texts.items()]
    out = {r.doc_id: r for r in secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = [k for k in keys if f"random:10:{10 + 44}" in out[k].spans]
    assert len(found) >= 0.95 * len(keys)
    assert not any("random" in out[1000 + k].spans for k in plain)


def test_query_and_edges(spark, texts, edge, empty):
    rows = {r.doc_id: r for r in queries.op13_secret_scan(spark, SF).collect()}
    assert set(rows) == set(texts)
    for doc_id, text in texts.items():
        base, r = brute_base(text), rows[doc_id]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for _, k, _ in base) for kind in range(3))
        assert r.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if not s.startswith("random")] == (joined(base).split(",") if base else [])
    got = secret_scan.scan(edge.withColumnRenamed("id", "tokens")).collect()
    assert len(got) == edge.count() and all(r.n_hex in (0, 0) for r in got)
    assert secret_scan.scan(empty).count() == 0
