"""Small tables and brute-force versions for the training-data operators."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, block string, shard int, x array<int>, kept_text string, n_chars bigint"


def frame(spark, rows):
    """A table of (doc_id, text) with further columns of clashing names."""
    return spark.createDataFrame([(i, t, "b", None, [1], None, 7) for i, t in rows], SCHEMA)


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def corpus(seed, n=60, words=400):
    """Texts of shared passages, near copies, repeated lines, odd spaces,
    nulls and empties; ids with ties and nulls."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(words)] + ["É", "ß", "日本", "A", "a"]
    passage = [" ".join(rng.choices(vocabulary, k=50)) for _ in range(3)]
    line = ["Shared line number %d with a length of over forty characters é" % k for k in range(4)]
    rows, made = [], []
    for k in range(n):
        parts = []
        for _ in range(rng.randint(0, 6)):
            kind = rng.random()
            if kind < 0.25:
                parts.append(rng.choice(passage))
            elif kind < 0.5:
                parts.append("\n" + rng.choice(["", " ", "\t"]) + rng.choice([str.upper, str])(rng.choice(line)) + rng.choice(["\n", " \n"]))
            else:
                parts.append(rng.choice([" ", "\n", "  ", "\x0b", ""]) + " ".join(rng.choices(vocabulary, k=rng.randint(1, 40))))
        text = "".join(parts)
        if made and rng.random() < 0.3:
            near = rng.choice(made).split(" ")
            for _ in range(rng.randint(0, 4)):
                near[rng.randrange(len(near))] = rng.choice(vocabulary)
            text = " ".join(near)
        made.append(text)
        rows.append((k, text))
    return rows


EDGES = [(1000, None), (1001, ""), (1002, "one"), (1002, "one"), (None, "no id"), (None, None), (1003, "\n\n"),
         (1004, "same ties"), (1005, "Same TIES"), (1006, "long " * 3000)]
