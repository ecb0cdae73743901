import random
import re
import textwrap

from ledgerflow.llm import license_scan as ls

SCHEMA = "doc_id long, text string, words string, labels int"


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, notices=ls.NOTICES):
    w, places, base, best, own = words(text), [], set(), 0.0, set()
    for phrase, label in ls.PHRASES.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                places.append(i)
                base.add(label)
    blocks = [set(words(b)) for b in re.split(ls.BLOCK_END, text or "")]
    for n in notices:
        t = n.text.split()
        m = set(t)
        if n.in_order:
            share = float(f" {n.text} " in f" {' '.join(w)} ")
        else:
            windows = [set(w[i:i + 2 * len(t)]) for i in range(0, len(w), len(t))]
            share = max((len(b & m) / len(m) for b in blocks + windows if n.share[1] * len(b & m) >= n.share[0] * len(m)), default=0.0)
        if share:
            own.add(n.label)
            best = max(best, share)
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | own)),
            1.0 if places else best)


def test_equals_brute_force(spark):
    rnd = random.Random(1)
    bits = [*ls.PHRASES, *[n.text for n in ls.TEMPLATES], *[n.text for n in rnd.sample(ls.REFERENCES, 40)], "CC-BY", "cc  by", "ccby", "cc by cc by", "CC\nBY", "General Public License", "Key", "İ", "é", ". ", "\n",
            "(c) all RIGHTS reserved.", "word", "{", "0", "-"]
    texts = []
    for _ in range(500):
        parts = [rnd.choice(bits) for _ in range(rnd.randint(0, 8))]
        if rnd.random() < 0.5:
            parts = [" ".join(x for x in p.split(" ") if rnd.random() < 0.9) for p in parts]
        if rnd.random() < 0.3:  # words wrapped over lines
            parts = [rnd.choice(["\n", "\n# ", " "]).join(p.split(" ")) for p in parts]
        texts.append(rnd.choice([" ", ", ", "\n"]).join(parts))
    texts += [None, "", "...", "a " * 20000 + "cc by"]
    rows = [(i if i else None, t, "x", 1) for i, t in enumerate(texts)] + [(3, texts[3], "x", 1)]
    got = sorted((tuple(r) for r in ls.scan(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == sorted(((i, *brute(t)) for i, t, *_ in rows), key=repr)
    assert ls.scan(spark.createDataFrame([], SCHEMA)).count() == 0


def test_short_references_carry_their_label(spark):
    texts = {"Released under the MIT License.": "mit", "SPDX-License-Identifier: BSD-3-Clause": "bsd", "under the MIT\n# licence": "mit",
             "Licensed under the Mozilla Public License 2.0": "mpl-2.0", "distributed under the terms of the 3-clause BSD license": "bsd",
             "released under the license of the project": "", "the MIT campus grants a license": "", "SPDX-License-Identifier: MITX": ""}
    rows = ls.scan(spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], SCHEMA)).collect()
    assert {r.doc_id: (r.labels, r.score) for r in rows} == {i: (label, 1.0 if label else 0.0) for i, label in enumerate(texts.values())}


def test_query_finds_short_references_of_the_table(spark):
    from conftest import SF_CHECK

    from ledgerflow.llm.queries import op7_license_scan

    docs = {r.doc_id for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect() if "Released under the MIT License." in (r.text or "")}
    rows = {r.doc_id: r for r in op7_license_scan(spark, SF_CHECK).collect()}
    assert docs and all("mit" in rows[i].labels.split(",") and rows[i].score == 1.0 for i in docs)


def test_hard_wrapped_notices_are_found_whole(spark):
    def wrap(text, width, mark):
        return "\n".join(mark + line for line in textwrap.wrap(text, width))

    rows = []
    for label, t, *_ in ls.TEMPLATES:
        for mark in ("", " * ", "# "):
            for before in (0, 1, 7, 50):
                rows.append((len(rows), "before " * before + "\n" + wrap(t, 30, mark) + "\n" + "after " * 9, label, 1))
    apart = " word" * 60
    rows.append((len(rows), apart.join(ls.TEMPLATES[1].text.split()), "", 1))
    got = {r.doc_id: r for r in ls.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all((label in got[i].labels.split(",") and got[i].score == 1.0) if label else got[i].labels == "" for i, _, label, _ in rows)


def test_notices_are_an_argument_and_the_index_is_exact(spark):
    """Random notices over few words, so that prefixes, ties and thresholds all matter."""
    rnd = random.Random(3)
    vocabulary = [f"v{i}" for i in range(30)]
    notices = [ls.Notice(f"l{i % 25}", " ".join(rnd.choices(vocabulary, k=rnd.randint(1, 14))), rnd.choice([(8, 10), (1, 2), (1, 1), (1, 3)]), rnd.random() < 0.2)
               for i in range(40)]
    texts = [rnd.choice([" ", "\n", ". "]).join(rnd.choices(vocabulary, k=rnd.randint(0, 60))) for _ in range(200)] + [n.text for n in notices]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)]
    got = {r.doc_id: (r.labels, round(r.score, 12)) for r in ls.scan(spark.createDataFrame(rows, SCHEMA), notices=notices).collect()}
    want = {i: brute(t, notices) for i, t, *_ in rows}
    assert got == {i: (x[5], round(x[6], 12)) for i, x in want.items()}


def test_the_index_is_one_literal_and_no_python_runs(spark):
    plan = ls.scan(spark.createDataFrame([(1, "a", "x", 1)], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "Python" not in plan and "Arrow" not in plan
