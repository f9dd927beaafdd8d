"""Small document tables with awkward rows, and digests."""

import hashlib
import random

ODD_TEXTS = [None, "", " ", "\n", "\n\n", "ß", "a", "\u0000x", "😀 \u2028 é", "word " * 40_000, "x" * 50_000]
#: Names that operators use inside, some of them in other case.
CLASHING = ["row", "row.text", "a`b", "body", "HASH", "key", "id0", "a", "b", "lines", "n_lines", "score", "x", "found"]


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def docs_frame(spark, rows, extra=()):
    """Rows are texts, or pairs of id and text; ``extra`` columns hold NULL and a number."""
    pairs = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
    names = "".join(f", `{name.replace("`", "``")}` bigint" for name in extra)
    filled = [(*p, *(None if p[0] is None else p[0] for _ in extra)) for p in pairs]
    return spark.createDataFrame(filled, "doc_id bigint, text string" + names)


def prose(seed, n, vocabulary=2000):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
