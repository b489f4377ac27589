"""Token counts against the tokenizer run on whole texts."""

import random

import public_tokenizers
import pytest
from fixtures import ODD_ROWS, clashing, frame

from stockflow.llm import tokens

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return tokens.checked_tokenizer(PATH)


def test_pre_tokens_add_up_to_the_whole_text(model):
    rng = random.Random(4)
    parts = [" ", "  ", "\n", "\t", "a", "the", "é", "23", "▁", "<s>", "</s>", "<unk>", "<0x0A>", "中文", "　", "😀", "\x00", "."]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        assert sum(tokens.n_pieces(model, tokens.pre_tokens(text))) == len(model.encode(text)), repr(text)


@pytest.mark.parametrize("most", [0, 3, 1 << 19])
def test_every_row_has_its_count(spark, model, most):
    found = tokens.count_tokens(clashing(frame(spark)), PATH, most=most).collect()
    expected = [(i, len((t or "").encode()), len(model.encode(t or ""))) for i, t, *_ in ODD_ROWS]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


def test_no_rows(spark):
    assert tokens.count_tokens(frame(spark, []), PATH).collect() == []
