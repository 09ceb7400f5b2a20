"""Small tables with every hard case, and plain versions to compare with."""

import random
import re

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "doc string, text_key int, node int, h int, size string, shard string, key int, start int, __doc int"
)
EXTRA = ("x", 1, 2, 3, "y", "z", 4, 5, 6)


def make_texts(seed=1, n=60):
    """Prose of few words with copies, edited copies, shared passages and lines."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(150)] + ["Tree,", "river.", "größe", "ÉTÉ", "日本語", "a|b"]
    prose = lambda k: " ".join(rng.choice(words) for _ in range(k))
    passage = prose(30)
    out = []
    for i in range(n):
        kind = i % 6
        if kind == 1 and out:
            out.append(out[rng.randrange(len(out))])
        elif kind == 2 and out:
            old = out[rng.randrange(len(out))].split(" ")
            old[rng.randrange(len(old))] = "edited"
            out.append(" ".join(old))
        elif kind == 3:
            out.append(f"{prose(rng.randrange(3, 40))}\n{passage}\t{prose(8)}  ")
        elif kind == 4:
            out.append("\n".join(["one line of a few words here"] * rng.randrange(1, 5) + [prose(25)]))
        else:
            out.append(prose(rng.randrange(1, 120)))
    return out


def frame(spark, texts, ids=None, source="s"):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", source, None if t is None else len(t), *EXTRA) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, SCHEMA)


def hard(spark):
    """NULL and blank texts, NULL and repeated ids, repeated rows, a very long text."""
    long = " ".join(f"l{i % 977}" for i in range(60_000))
    texts = [None, "", " \n\t ", "one", "one two", "same text " * 12, "same text " * 12, "no id here " * 9, "no id here " * 9, long]
    ids = [1, 2, 3, 4, 5, 6, 6, None, None, 9]
    return frame(spark, texts, ids)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def jaccard_components(texts, size, num, den):
    """Smallest reachable index of each text, by comparing all pairs."""
    sets = []
    for t in texts:
        low = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(low[i : i + size]) for i in range(max(1, len(low) - size + 1))} if low else set())
    links = [
        (i, j)
        for i, a in enumerate(sets)
        for j, b in enumerate(sets[:i])
        if a and b and den * len(a & b) >= num * len(a | b)
    ]
    return sets, components(range(len(texts)), links)


def cut_repeats(texts, size):
    """What is left of each text without windows that start earlier elsewhere."""
    seen, out = set(), []
    for t in texts:
        own, gone = words(t), set()
        for i in range(len(own) - size + 1):
            window = tuple(own[i : i + size])
            if window in seen:
                gone |= set(range(i, i + size))
            seen.add(window)
        out.append([w for i, w in enumerate(own) if i not in gone])
    return out
