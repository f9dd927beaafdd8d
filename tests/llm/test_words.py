import random
import re

import numpy as np
import pyarrow as pa

from holdfast.llm import words

from .helpers import ODD_TEXTS, prose

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def split(text, table):
    """Words of one text, and their hashes, alone in a block."""
    block = next(words.blocks(pa.array([text]), table))[1]
    data = block.data.tobytes()
    return [data[s:e].decode() for s, e in zip(block.starts, block.ends)], block.hashes.tolist()


def test_words_and_hashes_do_not_depend_on_neighbours():
    rng, table = random.Random(1), words.byte_table()
    texts = [t or "" for t in ODD_TEXTS] + [
        "".join(rng.choices(["ab", "é", " ", "\n", "\x0b", "😀", ".", "\x1c", "\xa0"], k=30))
        for _ in range(50)
    ]
    for max_bytes in (1, 40, 1 << 20):
        for column in (pa.array(texts), pa.array(["x", *texts])[1:], pa.array(texts, pa.large_string())):
            seen = 0
            for row, block in words.blocks(column, table, max_bytes):
                for i in range(block.size):
                    own = slice(block.first[i], block.first[i + 1])
                    found, hashes = split(texts[row + i], table)
                    data = block.data.tobytes()
                    assert found == [w for w in BLANK.split(texts[row + i]) if w]
                    assert [data[s:e].decode() for s, e in zip(block.starts[own], block.ends[own])] == found
                    assert block.hashes[own].tolist() == hashes
                    seen += 1
            assert seen == len(texts)


def test_case_and_punctuation():
    table = words.byte_table(lower=True, punctuation=False)
    texts = ["Écoute, CIÓN 'ÀÞ' ×÷ ß", "écoute ción àþ ×÷ ß", "ÉCOUTE... CIÓN Àþ ×÷ ß"]
    assert len({tuple(split(t, table)[1]) for t in texts}) == 1
    assert split("Ā", table)[1] != split("ā", table)[1]
    assert split("×", table)[1] != split("÷", table)[1]


def test_windows_stay_in_their_text():
    texts = [" ".join(prose(i, n)) for i, n in enumerate((0, 3, 1, 7, 2))]
    block = next(words.blocks(pa.array(texts + texts), words.byte_table()))[1]
    at, hashes = block.windows(3)
    assert len(at) == 2 * (1 + 5)
    assert hashes[:6].tolist() == hashes[6:].tolist() and len(set(hashes.tolist())) == 6


def test_equal_words_have_equal_hashes_and_others_not():
    vocabulary = {"".join(random.Random(i).choices("abcdé", k=1 + i % 300)) for i in range(3000)}
    _, hashes = split(" ".join(sorted(vocabulary)), words.byte_table())
    assert len(set(hashes)) == len(vocabulary)
    assert np.unique(words.mix(np.arange(1000, dtype=np.uint64))).size == 1000
