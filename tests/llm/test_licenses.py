import re
import textwrap

import numpy as np
import pyarrow as pa

from prumo.llm import licenses as L


def test_held_out_notices():
    """Sentences the model was not fitted on: their families are found, and others stay unknown."""
    model = L.fit(["the river ran over the old stones", "a list of names and places"] * 20)

    def best(text):
        row, feature = L.grams(L.paragraphs(pa.array([text])))
        own = np.unique(model.number[feature[model.number[feature] >= 0]])
        p = L._softmax((model.weights[own].sum(axis=0) + model.bias) / model.temperature)
        return ["", *L.FAMILIES][int(p.argmax())] if p.max() >= L.LEAST_PROBABILITY else ""

    right = {
        "The code in this folder is made available under the Apache License, Version 2.0, by us.": "Apache-2.0",
        "All sources are released under the MIT License": "MIT",
        "Texts of this site: CC BY-NC 4.0": "CC-BY-NC",
        "Its parts fall under the GNU Lesser General Public License.": "LGPL",
        "We chose the GNU General Public License, version 3 for it": "GPL-3.0",
        "Licensed under the Marigold License.": "",
        "He lost his driving licence in the rain.": "",
        "over the hills and far away": "",
    }
    assert {t: best(t) for t in right} == right


def test_rows(spark):
    texts = [None, "", "first\n\nReleased under the MIT License.\nthe end", "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0.", "Licensed under the Acme Internal License.", "no licence here"]
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)] + [(None, texts[2], 2), (2, texts[2], 1)], "doc_id long, text string, families int")
    got = sorted(((r.doc_id, r.n_paragraphs, r.n_licensed, r.families, r.paragraphs) for r in L.scan(docs).collect()), key=str)
    want = [(0, 0, 0, [], []), (1, 0, 0, [], []), (2, 3, 1, ["MIT"], [1]), (2, 3, 1, ["MIT"], [1]), (3, 2, 2, ["Apache-2.0", "CC-BY-NC"], [0, 1]), (4, 1, 0, [], []), (5, 1, 0, [], []), (None, 3, 1, ["MIT"], [1])]
    assert got == sorted(want, key=str)
    assert L.scan(docs.limit(0)).collect() == []


def test_planted_lines(spark):
    """Against a search for the licence lines that the test table is known to hold."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lines = {"Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC"}
    want = {r.doc_id: sorted({f for line, f in lines.items() if re.search(f"^{re.escape(line)}$", r.text, re.M)}) for r in docs.collect()}
    got = {r.doc_id: r.families for r in L.scan(docs).collect()}
    assert got == want and any(want.values())


def test_licence_bodies_and_wrapped_notices(spark):
    """Paragraphs of licence texts, in one line or wrapped, and notices over two lines."""
    wrap = lambda t, n: "\n".join(textwrap.wrap(t, n))
    bodies = [(f, b) for f in ("MIT", "BSD", "ISC", "Apache-2.0", "GPL-2.0", "GPL-3.0", "MPL-2.0") for b in L.BODIES[f][:1]]
    texts = [(f, t) for f, b in bodies for t in (b, f"some words before\n\n{wrap(b, 70)}\n\nand after", f"/*\n{wrap(b, 50)}\n*/")]
    texts += [("Apache-2.0", "the start\nThis work is licensed under the Apache\nLicense, Version 2.0.\nthe end"), ("GPL-3.0", "This work is licensed under the GNU\nGeneral Public License, version 3.")]
    texts += [("", "permission was granted to him\nfree of charge by the mayor\nto use the old mill and its copies of the map"), ("", "The redistribution of land and its use\nin many forms is permitted here")]
    docs = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.families, r.n_licensed) for r in L.scan(docs).collect()}
    assert got == {k: ([f] if f else [], int(bool(f))) for k, (f, _) in enumerate(texts)}


def test_names_alone_are_no_notices(spark):
    texts = ["We joined MIT. Copyright (c) the authors.", "Copyright (c) the authors.", "She studied at MIT.", "Copyright (c) the authors. MIT.", "The ISC met in May."]
    got = {r.doc_id: r.families for r in L.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {0: [], 1: [], 2: [], 3: ["MIT"], 4: []}


def test_recall_on_changed_paragraphs(spark):
    """Altered copies (words missing, others around) of the body paragraphs that the model is fitted on: it bears changes; this says nothing of
    paragraphs that it has never seen."""
    rng, texts = np.random.default_rng(77), []
    for family, bodies in L.BODIES.items():
        for body in bodies:
            for _ in range(4):
                words = [w for w in body.split() if rng.random() > 0.04]
                texts.append((family, " ".join(["see", "below", *words, "end", "of", "part"])))
    docs = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.families for r in L.scan(docs).collect()}
    per: dict[str, list[bool]] = {}
    for k, (family, _) in enumerate(texts):
        per.setdefault(family, []).append(family in got[k])
    assert {f: sum(v) / len(v) for f, v in per.items() if sum(v) < 0.9 * len(v)} == {}


PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def codes(words):
    return L.paragraphs(pa.array([" ".join(words)])).codes


def pairs(words):
    own = codes(words)
    return set(L.windows(own, 2).tolist()) or set(own.tolist())


def plain_scan(text, model, known):
    """(families, places, likely ones that nothing confirms, highest probability) of one text, unit by unit."""
    lines, blocks, empty = [], [], True
    for line in (text or "").split("\n"):
        words = [w.decode() for w in line.encode().split()]
        core = [c for c in (w.strip(PUNCTUATION) for w in words) if c]
        if not words:
            empty = True
        if core:
            if empty or not blocks:
                blocks.append([])
            blocks[-1].append(len(lines))
            lines.append(core)
        empty = empty and not core

    def judged(a, b):
        words = [w for line in lines[a:b] for w in line]
        features = {int(model.number[int(h) % L.BUCKETS]) for k in (1, 2, 3) for h in L.windows(codes(words), k)} - {-1}
        if not features:
            return None
        raw = [(sum(model.weights[f][c] for f in features) + model.bias[c]) / model.temperature for c in range(len(model.bias))]
        e = [np.exp(x - max(raw)) for x in raw]
        best = max(range(len(e)), key=lambda c: e[c])
        return (best, e[best] / sum(e), pairs(words)) if best and e[best] / sum(e) >= L.LEAST_PROBABILITY else None

    units = [(0, k, k + 1) for k in range(len(lines))] + [(L.LEAST_BLOCK, b[0], b[-1] + 1) for b in blocks if len(b) > 3]
    for w in (3, 2):
        units += [(1, k, k + w) for phase in range(w) for k in range(phase, len(lines), w) if any(b[0] <= k and k + w <= b[-1] + 1 for b in blocks)]
    names, found, doubted = ["", *L.FAMILIES], [], set()
    for least, a, b in units:
        own = judged(a, b)
        if own is None or least and any(c < b and d > a and (d - c > 1 or f == names[own[0]]) for f, c, d, _ in found):
            continue
        best, share, mine = own
        if any(len(t.pairs) >= least and t.must <= mine and len(t.pairs & mine) >= L.LEAST_SHARED * len(t.pairs) for t in known[best]):
            found.append((names[best], a, b, share))
            doubted -= set(range(a, b))
        elif not least:
            doubted.add(a)
    return sorted({f for f, *_ in found}), sorted(a for _, a, _, _ in found), len(doubted), max((s for *_, s in found), default=0.0), len(lines)


def odd_licence_texts(rng):
    notices = [p.format(n) for p in L.PATTERNS[:6] for own in L.FAMILIES.values() for n in own[:2]]
    bodies = [b for own in L.BODIES.values() for b in own]
    other = ["the river ran over the old stones", "see version 3 of the form", "-- * --", "", "", "MIT", "License: unknown to us"]
    for _ in range(120):
        lines = []
        for _ in range(rng.integers(0, 9)):
            kind = rng.random()
            text = rng.choice(notices) if kind < 0.3 else rng.choice(bodies) if kind < 0.45 else rng.choice(other)
            if len(text) > 40 and rng.random() < 0.5:
                lines += textwrap.wrap(str(text), int(rng.integers(25, 70)))
            else:
                lines.append(str(text))
        yield "\n".join(lines)


def test_scan_equals_unit_by_unit(spark):
    """Scoring and confirmation against a plain version, text by text, on made texts and on the given table."""
    given = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").filter("length(text) < 3000").limit(60).collect()]
    texts = [None, "", "!!", *odd_licence_texts(np.random.default_rng(4)), *given]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    able = docs.filter("octet_length(coalesce(text, '')) <= 65536").orderBy("doc_id").limit(L.NEGATIVE_DOCS)
    got = {r.doc_id: r for r in L.scan(docs.repartition(3)).collect()}
    assert able.count() == len(texts) <= L.NEGATIVE_DOCS  # all of them are the sample
    model, known = L.fitted(L.negatives(texts)), L.templates()
    for k, t in enumerate(texts):
        families, places, doubted, most, n = plain_scan(t, model, known)
        r = got[k]
        assert (r.families, r.paragraphs, r.n_unconfirmed, r.n_paragraphs, r.n_licensed) == (families, places, doubted, n, len(places)), t
        assert abs(r.probability - most) < 1e-9
    assert sum(bool(r.families) for r in got.values()) > 40
