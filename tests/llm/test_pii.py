"""PII against a plain Python version of the base forms, and its parts."""

import hashlib
import random
import re

import regex

from ledgerflow.llm import pii

SCHEMA = "doc_id long, text string, kind string, spans string"


def luhn(d):
    t = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        t += x - 9 if x > 9 else x
    return t % 10 == 0


def brute(text):
    out = []
    for kind, pat in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
                      ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
                      ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pat, text):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and any(int(p) > 255 for p in m[0].split("."))
                    or kind == "card" and not (12 <= len(d) <= 19 and luhn(d)) or kind == "phone" and not 9 <= len(d) <= 15):
                continue
            out.append((m.start(), pii.KINDS.index(kind), m.end(), kind))
    return sorted(out)


def listed(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)


def texts():
    rnd = random.Random(7)
    bits = ["a@b.co", "x_y@d-e.f.com", "@", ".", "..", "1.2.3.4", "999.1.1.1", "001.2.3.0255", "1.2.3.4.5", "4111 1111 1111 1111",
            "4111111111111111", "5500-0000-0000-0004", "+1 (555) 010-9999", "+4", "+49 30 1234567", " ", " ", "\n", "é", "😀", "-",
            "12", "7", "a", "b_c", "%", "+", "123-45-6789", "(555) 234-5678", "call ", "jo [at] ex [dot] org"]
    out = ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 14))) for _ in range(600)]
    return out + [None, "", "a" * 3000, "1" * 3000, "1 " * 3000, "+1" + " " * 3000, "a@b.c " * 600, "9." * 900, "😀 a@b.co"]


def test_base_spans_equal_brute_force(spark):
    rows = [(i, t, "x", "y") for i, t in enumerate(texts())]
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len(rows)
    for i, t, *_ in rows:
        want, r = brute(t or ""), got[i]
        assert r.base_sha256 == hashlib.sha256(listed(want).encode()).hexdigest(), t
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w[3] == k for w in want) for k in pii.BASE_KINDS]
        assert set(listed(want).split(",")) - {""} <= set(r.spans.split(","))


def test_nulls_repeats_and_empty_table(spark):
    rows = [(None, "a@b.co", None, None), (1, None, None, None), (1, None, None, None)]
    out = pii.find(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id is None, r.spans) for r in out) == [(False, ""), (False, ""), (True, "email:0:6")]
    assert pii.find(spark.createDataFrame([], SCHEMA)).count() == 0


def test_label_model_trusts_agreeing_labelers():
    table = [((2, 1, 1, 0, 1, 2), 100), ((2, -1, -1, 0, -1, 2), 100), ((2, -1, 1, 0, 1, 2), 5)]
    post = pii.label_model(table)
    assert post[(2, 1, 1, 0, 1)] > 0.9 and post[(2, -1, -1, 0, -1)] < 0.1
    assert len(pii.train(table)) == len(pii._features(table[0][0]))


def test_redaction_replaces_spans_only(spark):
    rows = [(1, "mail a@b.co, 4111111111111111 end", "k", "s"), (2, "clean 12 text", "k", "s"), (3, None, "k", "s")]
    df = pii.redacted(spark.createDataFrame(rows, SCHEMA))
    assert df.columns == ["doc_id", "text", "kind", "spans"]
    out = {r.doc_id: r.text for r in df.collect()}
    assert out == {1: "mail [EMAIL], [CARD] end", 2: "clean 12 text", 3: None}


def gazetteer(kind, hit):
    """A second version of the lists' votes: True, False."""
    digits = re.sub("[^0-9]", "", hit)
    if kind == "email":
        return hit.lower().rstrip(")] ").replace("]", ".").replace(")", ".").replace(" ", ".").rpartition(".")[2] in pii.TOP_DOMAINS.split("|") and hit[-1] not in ")] "
    if kind == "ip":
        head = hit + "."
        first, second = hit.split(".")[:2]
        private = head.startswith(("0.", "10.", "127.", "192.168.")) or hit.startswith("169.254.") or first == "172" and second in [str(i) for i in range(16, 32)]
        return not (private or first in [str(i) for i in range(224, 300)])
    if kind == "card":
        return digits.startswith(("4", "34", "37", "35", "6011", "62", "64", "65", *[f"5{i}" for i in range(1, 6)], *[f"2{i}" for i in range(2, 8)]))
    if kind == "ssn":
        a, b, c = hit.split("-")
        return not (a in ("000", "666") or a[0] == "9" or b == "00" or c == "0000")
    if hit.startswith("+"):
        return hit[1:].startswith(tuple(pii.CALLING_CODES.split("|")))
    return digits[0] in "23456789" and digits[3] in "23456789"


def candidates(text):
    """(start, kind, end, base, shape, gazetteer, context, edges, length) of every candidate of a text."""
    out = []
    for kind, pattern, strict in [(k, p, True) for k, p in pii.STRICT.items()] + [(k, p, False) for k, p in pii.LOOSE.items()]:
        hits = [m.span() for m in regex.finditer(pattern, text)]
        for i, (a, b) in enumerate(hits):
            hit, d = text[a:b], re.sub("[^0-9]", "", text[a:b])
            ok = strict and (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in hit.split("."))
                             or kind == "phone" and 9 <= len(d) <= 15 or kind == "card" and 12 <= len(d) <= 19 and luhn(d))
            before = text[max(hits[i - 1][1] if i else 0, a - 32):a]
            after = text[b:b + 1] if i + 1 == len(hits) or hits[i + 1][0] > b else ""
            glued = bool(regex.search(r"[\p{L}0-9]$", before[-1:]) or regex.match(r"[\p{L}0-9]", after))
            context = 1 if re.search(pii.CUES[kind], before) else -1 if re.search(pii.COUNTER_CUES, before) else 0
            out.append((a, pii.KINDS.index(kind), b, ok, (1 if ok else -1) if strict else 0, 1 if gazetteer(kind, hit) else -1, context, -1 if glued else 1,
                        0 if len(hit) < 8 else 1 if len(hit) < 16 else 2))
    base = [c for c in out if c[3]]
    return sorted(c for c in out if c[3] or not any(b[0] < c[2] and c[0] < b[2] for b in base))


def test_candidates_votes_and_added_spans_equal_a_second_version(spark):
    rnd = random.Random(9)
    cues = ["call ", "phone: ", "invoice 12 ", "ssn ", "e-mail ", "order ", "version ", "card ", "host ", "x", "7"]
    loose = ["123-45-6789", "(555) 234-5678", "555 134 5678", "jo [at] ex [dot] org", "a.b(at)c(dot)zz", "000-12-3456", "999-00-1234", "4111 1111 1111 1112", "10.0.0.1",
             "300.1.1.1", "a@b.co", "+49 30 1234567", "+999 1", "5500-0000-0000-0004"]
    made = [" ".join(rnd.choice(cues) + rnd.choice(loose) + rnd.choice(["", "x", ".", " é"]) for _ in range(rnd.randint(1, 6))) for _ in range(250)]
    every = [t for t in [*texts(), *made] if t]
    every.append(" ".join(rnd.choice(cues) + rnd.choice(loose) for _ in range(1500)))  # many spans in one long text
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(every)], SCHEMA)
    want = {i: candidates(t) for i, t in enumerate(every)}
    fields = ["start", "kind", "end", "base", *pii.VOTES, "length"]
    got = {r.doc_id: [tuple(c[f] for f in fields) for c in r[pii.WORK + "candidates"]] for r in pii.with_candidates(df).collect()}
    for i, t in enumerate(every):
        assert got[i] == want[i], t[:200]
    counts = {}
    for cs in want.values():
        for c in cs:
            counts[(c[1], *c[4:])] = counts.get((c[1], *c[4:]), 0) + 1
    weights = pii.train(sorted(counts.items()))
    odds = lambda c: sum(w * x for w, x in zip(weights, pii._features((c[1], *c[4:])), strict=True))
    spans = {i: ",".join(f"{pii.KINDS[c[1]]}:{c[0]}:{c[2]}" for c in cs if c[3] or odds(c) >= 0) for i, cs in want.items()}
    assert {r.doc_id: r.spans for r in pii.find(df).collect()} == spans
    assert any(odds(c) >= 0 and not c[3] for cs in want.values() for c in cs) and any(odds(c) < 0 for cs in want.values() for c in cs)
