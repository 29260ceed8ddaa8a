"""Small tables with the awkward rows every operator must take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: The same with columns whose names clash with those that operators use or add, some only in case.
CLASHING = SCHEMA + ", TEXT string, id long, mark int, row string, size int, lines_removed string, score string, sequence_id int, shard int"
CLASH_VALUES = ("other", 7, 8, "r", 9, "x", "s", 10, 11)


def sentences(seed, count, words=60, vocabulary=400):
    rng = random.Random(seed)
    names = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randrange(2, 9))) for _ in range(vocabulary)]
    texts = []
    for _ in range(count):
        lines, own = [], [rng.choice(names) for _ in range(rng.randrange(1, words))]
        while own:
            k = rng.randrange(1, 9)
            lines.append(" ".join(own[:k]))
            own = own[k:]
        texts.append("\n".join(lines))
    return texts


def rows(texts):
    return [(i, t, "en", None if i % 7 == 3 else f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]


def awkward():
    """Null, empty, blank, one-word and long texts, copies, repeated rows, and a null id."""
    rng = random.Random(4)
    base = sentences(1, 25)
    near = base[3].replace("\n", " \n", 1) + "\nextra words here"
    long = " ".join(rng.choice(["tree", "lake", "stone", "wind", "rain"]) + str(rng.randrange(900)) for _ in range(6000))
    texts = [None, "", " \n\t ", "one", "A a", *base, base[0], base[0], base[1].upper(), near, long, "\n".join(["same line"] * 9), "x\x0by\x0cz\r\n"]
    out = rows(texts)
    return [*out, out[6], out[6], (None, base[2], "en", "s0", 3), (None, None, None, None, None)]
