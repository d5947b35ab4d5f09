import random
import re

import pyarrow as pa
import pytest

from prumo.llm import decontaminate as D


def tokens(text):
    """(code, value) of a text's template tokens, word by word."""
    out, opens, prev_number = [], True, False
    for line in (text or "").split("\n"):
        opens = True
        for word in line.encode().split():
            word = word.decode()
            core = re.sub(r"^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$", "", word)
            if core:
                low = "".join(c.lower() if "A" <= c <= "Z" else c for c in core)
                if re.search("[0-9]", core):
                    code = "<num>"
                elif prev_number and low in D.UNITS:
                    code = "<unit>"
                elif not opens and re.match(r"[A-ZÀ-Þ][^A-ZÀ-Þ]", core):
                    code = "<name>"
                else:
                    code = low
                prev_number = code == "<num>"
                if out and code[0] == "<" and out[-1][0] == code:
                    out[-1] = (code, out[-1][1] + " " + word.strip())
                else:
                    out.append((code, core))
            opens = word[-1] in ".!?:"
    return out


def test_template_equals_word_by_word():
    texts = [None, "", "Ask Bob Lee: how many km are 12 km, 5kg?\nMary (and JOHN) has 3 Apples. The É Étoile x", "!! ** a", "1 2 3 km km", "x 7 KM y", "Tom"]
    t = D.template(pa.array(texts))
    names = {int(D.NUM): "<num>", int(D.UNIT): "<unit>", int(D.NAME): "<name>"}
    for d, text in enumerate(texts):
        span = range(t.offsets[d], t.offsets[d + 1])
        got = [names.get(int(t.codes[i]), bytes(t.buf[t.starts[i] : t.ends[i]]).decode().lower()) for i in span]
        assert [g.lower() for g in got] == [c.lower() for c, _ in tokens(text)]


ITEMS = [
    (0, "Farmer Joan sold 12 apples to Mark for 3 dollars each and then bought 12 pears with the money she got from Mark today"),
    (1, "what is the capital of the old kingdom that lay behind the seven green hills near the sea"),
    (2, "one short item of five"),
    (3, "too short"),
    (None, "a null item that has more than enough words to be a window of its own here"),
    (4, None),
]


def test_kinds(spark):
    same = ITEMS[0][1]
    other = same.replace("Joan", "Anna").replace("Mark", "Paul").replace("12", "70").replace("3", "4")
    broken = same.replace("12 pears", "13 pears").replace("bought 12", "bought 13")
    docs = [(1, f"before it. {same} and after"), (2, f"x y z {other}"), (3, f"and {broken}"), (4, None), (5, ""), (6, "the capital of the old kingdom that lay behind the seven green hills near"), (7, "the old kingdom that lay behind"), (None, same), (8, "One SHORT ITEM of five!"), (9, "too short"), (2, f"x y z {other}")]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    frame = spark.createDataFrame([(*d, "n") for d in docs], "doc_id long, text string, n_items string")
    for passes in (1 << 20, 5):
        got = {(r.doc_id, r.contaminated, r.kind) for r in D.decontaminate(frame, items, pass_windows=passes).collect()}
        assert got == {(1, True, "verbatim"), (2, True, "reparameterised"), (3, False, None), (4, False, None), (5, False, None), (6, True, "verbatim"), (7, False, None), (None, False, None), (8, True, "verbatim"), (9, False, None)}
    assert sorted(str(r.doc_id) for r in D.keep_clean(frame, items).collect()) == ["3", "4", "5", "7", "9", "None"]
    assert D.decontaminate(frame.limit(0), items).collect() == []
    assert not D.decontaminate(frame, items.limit(0)).filter("contaminated").collect()


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]
    items = [(i, " ".join(rng.choice([*vocabulary, "7", "Bob"]) if rng.random() < 0.2 else rng.choice(vocabulary) for _ in range(rng.randint(3, 40)))) for i in range(12)]
    docs = []
    for d in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        if d % 2:
            own = rng.choice(items)[1].split()
            a = rng.randint(0, max(0, len(own) - 13))
            part = own[a : a + rng.randint(5, 25)]
            if d % 3 == 0:
                part = [{"7": "9", "Bob": "Al"}.get(w, w) for w in part]
            k = rng.randint(0, len(words))
            words[k:k] = part
        docs.append((d, " ".join(words)))
    cut = lambda t, n: {tuple(c for c, _ in t[i : i + n]) for i in range(len(t) - n + 1) if sum(c[0] == "<" for c, _ in t[i : i + n]) <= 0.4 * n}
    wanted = {}
    for _, text in items:
        t = tokens(text)
        n = min(13, len(t))
        if n >= D.SHORTEST:
            wanted.setdefault(n, set()).update(cut(t, n))
    want = {d for d, text in docs if any(cut(tokens(text), n) & w for n, w in wanted.items())}
    got = {r.doc_id for r in D.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).filter("contaminated").collect()}
    assert got == want and want


def found(spark, items, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    return {r.doc_id: r.kind for r in D.decontaminate(frame, spark.createDataFrame(items, "item_id long, text string")).filter("contaminated").collect()}


def test_slot_heavy_and_short_items_word_for_word(spark):
    """Items with too many slots for a template window, or too few tokens for one."""
    table = " ".join(f"Row{k} {k * 37} Bob Lee {k * 11} km" for k in range(9))
    items = [(0, "Compute 37 times 48 minus 12 divided by 6"), (1, table), (2, "Compute 91 + 8"), (3, "12 13 14 15 16 17"), (4, "no luck")]
    docs = [
        (0, "Q: compute 37 times 48 minus 12, divided by 6."), (1, "Compute 37 times 48 minus 12 divided by 7"), (2, f"see 4 {' '.join(table.split()[9:31])} 5 end"),
        (3, table.replace("Bob", "Al").replace("37", "38")), (4, "please compute 91 + 8 now"), (5, "compute 92 + 8"), (6, "a 11 12 13 14 15 16 17 18"), (7, "no luck"),
    ]
    assert found(spark, items, docs) == {0: "verbatim", 2: "verbatim", 4: "verbatim", 6: "verbatim"}


def test_words_around_a_copy_do_not_matter(spark):
    """Capitalised openings in mid-sentence, slots beside the copy's edges, and line breaks at other places."""
    long = "Farmer Joan sold 12 green apples to the old man from the hills and then Joan went home by the river"
    names = "on a cold day in the spring the boy called Mark went with the girl called Anna over the hill to see the sea"
    items = [(0, "What is the capital of the old kingdom"), (1, long), (2, names), (3, "In the old mill lay a sack of 7 coins"), (4, "Joan Smith paid the miller for a sack of 9 coins")]
    docs = [
        (0, "he asked, What is the capital of the old kingdom"), (1, f"then Farmer {long[7:]}"), (2, f"we heard that {long.replace('Joan', 'Anna')}"),
        (3, names.replace("called Mark", "called\nMark").replace("called Anna", "called\nAnna")), (4, "Question 5 In the old mill lay a sack of 8 coins"),
        (5, "they say Anna Brown paid the miller for a sack of 4 coins"), (6, "he asked, What is the capital of the new kingdom"), (7, "then Farmer " + long[7:].replace("then Joan", "then Anna")),
        (8, "Anna Smith paid the miller for a sack of 9 coins"),
    ]
    assert found(spark, items, docs) == {0: "verbatim", 1: "verbatim", 2: "reparameterised", 3: "verbatim", 4: "reparameterised", 5: "reparameterised", 8: "reparameterised"}
