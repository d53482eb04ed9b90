import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from dimweave.llm.word_ids import WordIds, Words, WordTable

from .conftest import ODD_TEXTS


@pytest.fixture(scope="module")
def spec(word_bpe):
    with open(word_bpe, encoding="utf-8") as f:
        return f.read()


def equal(model, library, texts):
    ids, begins = model.encode(texts)
    for i, t in enumerate(texts):
        assert ids[begins[i] : begins[i + 1]].tolist() == library.encode(t or "", add_special_tokens=False).ids, t


@pytest.mark.parametrize("own", [True, False])
def test_equals_the_library(spec, own):
    """Also when every chunk goes through the library, and with a cache that
    turns over within the texts."""
    model, library = WordIds(spec, entries=200), Tokenizer.from_str(spec)
    assert model.own
    model.own = own
    equal(model, library, ODD_TEXTS)
    rng = random.Random(5)
    alphabet = "abcXYZ019 '' ''slltdrevm.,!?<|>\n\té ÀŸſĿ İŉ²½ªµ\xa0\xad漢́éß"
    for _ in range(20):
        equal(model, library, ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(100)])
    equal(model, library, [])
    equal(model, library, [None, ""])


def test_every_character_between_letters(spec):
    model, library = WordIds(spec), Tokenizer.from_str(spec)
    equal(model, library, [f"a{chr(c)}b {chr(c)}{chr(c)}'s1{chr(c)}'ll" for c in [*range(0x300), *range(0x2000, 0x2070), 0x4E00, 0x1F600]])


def looked_up(table, words):
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
    starts = np.zeros(len(points), dtype=bool)
    starts[np.cumsum([0, *map(len, words[:-1])])] = True
    flat, counts = table.gathered(table.lookup(Words(points, starts)))
    return [own.tobytes() for own in np.split(flat, np.cumsum(counts)[:-1])]


@pytest.mark.parametrize("bits", [1, 3, 20])
def test_a_full_table_keeps_what_is_asked_for(bits):
    """Also with words that share a place, repeat, differ behind their eighth
    or sixteenth byte, and hold zero bytes."""
    learned = []

    def learn(words):
        learned.extend(words)
        return [w * 4 for w in words]

    table = WordTable(learn, entries=12, bits=bits)
    words = ["a", "b", "a", "a\0", "a\0\0", "é漢", "eightbyt", "eightbytes", "sixteenbytes1234", "sixteenbytes12345", "sixteenbytes12346"]
    for _ in range(3):
        assert looked_up(table, words) == [w.encode() * 4 for w in words]
    assert len(learned) == len(set(words))
    for n in range(20):
        assert looked_up(table, ["a", f"new{n}", f"another{n}"]) == [w.encode() * 4 for w in ("a", f"new{n}", f"another{n}")]
    assert learned.count(b"a") == 1 and len(table.numbers) <= 16
    assert looked_up(table, ["b"]) == [b"bbbb"]


def test_random_words_against_a_dictionary():
    rng = random.Random(9)
    table = WordTable(lambda words: [w + bytes(-len(w) % 4) for w in words], entries=300, bits=6)
    for _ in range(60):
        words = ["".join(rng.choices("abé漢\0z", k=rng.randint(1, 9))) for _ in range(80)]
        assert looked_up(table, words) == [(w := t.encode()) + bytes(-len(w) % 4) for t in words]
