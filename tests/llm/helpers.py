"""Small tables with every awkward case, and plain-Python versions of the contracts."""

from __future__ import annotations

import hashlib
import random
import re

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, key long, n_words int, size string"


def docs_frame(spark, texts, ids=None, sources=None):
    """Documents with extra columns whose names operators use inside."""
    rows = []
    for i, text in enumerate(texts):
        doc_id = i if ids is None else ids[i]
        source = f"s{i % 3}" if sources is None else sources[i]
        rows.append((doc_id, text, "en", source, len(text or ""), f"r{i}", i, -1, "x"))
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)


def words(text):
    """Runs of anything but the six white-space characters, A-Z in lower case."""
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall("[^\x20\x09-\x0d]+", low)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def prose(rng, n, vocab=None):
    vocab = vocab or [f"w{i}" for i in range(40)] + ["é", "The", "x.", "naïve"]
    return " ".join(rng.choice(vocab) for _ in range(n))


def awkward_texts(seed=5):
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(3, 60)) for _ in range(12)]
    texts = [None, "", " ", "\n\n", "one", "one two", "one two", None, base[0], base[0], base[0] + " tail", base[1].upper(),
             base[1], "a\n" + base[2], base[2] + "\nb", base[2], "𝒳     z", "\x0b\x0cq\r", *base, prose(rng, 30_000)]
    line = "a line that is long enough to count"
    return texts + [f"{line}\nfirst", f"  {line.upper()}\t\nsecond", f"x\n{line}\n{line}", f"{line[:-1]}\nother"]
