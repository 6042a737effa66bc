"""Samples of more symbols than the parse's table has columns."""

import random

import pytest

from turnmill.llm import language


def text_of(rng, first, count, length):
    return "".join(chr(first + rng.randrange(count)) for _ in range(length))


def test_rare_symbols_tell_languages_apart():
    rng = random.Random(9)
    many = ["".join(chr(0xAC00 + i) for i in range(300)) * 3] * 40  # these fill the table
    sample = {"a": many, "p": [text_of(rng, 0x4E00, 400, 900)], "q": [text_of(rng, 0x6E00, 400, 900), "x"]}
    model = language.train(sample)
    made = [text_of(rng, 0x4E00, 400, 60), text_of(rng, 0x6E00, 400, 60), sample["q"][0][100:200], sample["p"][0][5:99]]
    assert model.predict(made)[0] == ["p", "q", "q", "p"]


@pytest.mark.parametrize("columns", [2, 5, 256])
def test_lookups_equal_longest_matches(monkeypatch, columns):
    """Phrases by table and lookups equal a greedy parse by substring search."""
    monkeypatch.setattr(language, "SYMBOLS", columns)
    rng = random.Random(columns)
    alphabets = {"p": "aabcdefg h", "q": "abdxyzw é"}
    if columns == 256:
        alphabets = {x: a + "".join(chr(0x4E00 + i) for i in range(i0, i0 + 300)) for (x, a), i0 in zip(alphabets.items(), (0, 200))}
    sample = {x: ["".join(rng.choice(a) for _ in range(900)) for _ in range(2)] for x, a in alphabets.items()}
    model = language.train(sample)
    letters = "".join(alphabets.values()) + "ñ"
    made = ["".join(rng.choice(letters) for _ in range(n)) for n in (1, 2, 50, 700)]
    made += [sample["p"][0][10:90], sample["q"][1][:40] + sample["p"][1][40:80]]
    bits, _ = model.entropies(made)
    for i, lang in enumerate(model.languages):
        texts = ["".join(map(chr, language.symbols(t))) for t in sample[lang]]
        for j, made_text in enumerate(made):
            left, phrases = "".join(map(chr, language.symbols(made_text))), 0
            while left:
                n = 1
                while n < len(left) and any(left[: n + 1] in t for t in texts):
                    n += 1
                left, phrases = left[n:], phrases + 1
            assert bits[i, j] == pytest.approx(phrases * model.bits[i])
