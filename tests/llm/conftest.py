import random

import pytest

VOCABULARY = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "re", "sta", "Tö", "vé") for b in
              ("", "n", "r.", "s,", "tal", "mond", "ring", "Wald")]


def sentence(rng, n):
    return " ".join(rng.choice(VOCABULARY) + rng.choice(("", "", "x", "y", "z")) for _ in range(n))


def prose(rng, n):
    out = []
    while n > 0:
        k = min(n, rng.randint(5, 30))
        out.append(sentence(rng, k))
        n -= k
    return "\n".join(out)


def edge_rows():
    """Ordinary texts, copies, near copies, shared passages, and every odd case."""
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randint(20, 160))) for i in range(60)]
    passage = sentence(rng, 60)
    for i in range(60, 70):
        rows.append((i, prose(rng, 40) + "\n" + passage + "\n" + prose(rng, 30)))
    for i in range(70, 90):  # chains of near copies, some far from their source
        w = rows[i % 7][1].split(" ")
        for _ in range(1 + i % 4):
            w[rng.randrange(len(w))] = "changed" + str(rng.randrange(3))
        rows.append((i, " ".join(w)))
    rows += [(90, rows[3][1]), (91, rows[3][1]), (2000, rows[5][1])]
    rows += [(92, None), (93, ""), (94, " \n\t "), (95, "one"), (96, "One"), (97, "two words"),
             (98, "a " * 300), (99, "\n".join(["same line again here ok"] * 40))]
    rows += [(100, prose(rng, 30_000)), (101, "x" * 50_000)]
    rows += [(102, "### %%% | || <<>> ### $$$ *** &&& " * 10), (103, "ÄÖÜ é ñ ß 漢字 \u00a0 \u2003 end")]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (8, prose(rng, 50))]  # repeated row; an id with two texts
    rows += [(None, rows[2][1]), (None, None), (-5, rows[4][1])]
    return rows


CLASHES = ("n_words", "kept", "node", "value", "length", "slice", "payload", "quality", "item_id", "score",
           "start", "n", "digest", "text_sha256", "__id", "shard")


@pytest.fixture(scope="session")
def rows():
    return edge_rows()


@pytest.fixture(scope="session")
def odd(spark, rows):
    """``documents`` of odd rows, with columns named like the operators' own."""
    return make(spark, rows)


def make(spark, rows):
    extra = ", ".join(f"{c} string" for c in CLASHES)
    return spark.createDataFrame(
        [(d, t, None if i % 5 == 0 else "en", f"src{i % 3}", None if t is None else len(t), *(c for c in CLASHES))
         for i, (d, t) in enumerate(rows)],
        f"doc_id long, text string, lang string, source string, n_chars long, {extra}").repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return make(spark, []).select("*")
