"""Token counts and the transducer against the library itself."""

import random
import time

import pytest
from cases import no_documents, odd_documents

spm = pytest.importorskip("sentencepiece")
tokenizers = pytest.importorskip("public_tokenizers")

from reelmetrics.llm import token_counts as token_counts_module  # noqa: E402
from reelmetrics.llm.pieces import PieceModel  # noqa: E402
from reelmetrics.llm.token_counts import text_lengths, token_counts  # noqa: E402
from reelmetrics.llm.transducer import Encoder, Transducer, encode_decode  # noqa: E402

PATH = tokenizers.path("piece_bpe_32k.model")
FIXED = [
    "", " ", "  a  b ", "a\nb\tc", "<s>hi</s>", "ﬁ①é é", "\x00a", "▁x ▁ y", "😀", "a" * 700, "ab" * 500, " " * 333,
    "\n\n \n  x\n", "日本語 テスト   日", "▁▁a", "x\x00y \x00z", "=" * 99, "tion" * 80, "aaab" * 90, "​ ​",
]


def texts() -> list[str]:
    rng = random.Random(5)
    letters = "abcdehtinor eé  \n▁.,日0"
    return FIXED + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)]


@pytest.fixture(scope="module")
def library():
    return spm.SentencePieceProcessor(model_file=str(PATH))


def test_counts_equal_the_library(library):
    want = [len(x) for x in library.encode(texts())]
    assert text_lengths(PieceModel(PATH), {}, texts()) == want
    kept: dict = {}
    assert [text_lengths(PieceModel(PATH), kept, [t])[0] for t in texts()[:200]] == want[:200]


def test_paths_equal_the_library(library):
    encoder = Encoder(Transducer(PATH))
    ids, offsets = encoder.encode(texts())
    own = [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
    assert own == library.encode(texts())
    assert encoder.decode(ids, offsets) == library.decode(library.encode(texts()))


def long_texts() -> dict[str, str]:
    """Parts without a place to cut: letters as they fall, words run together, repeats, characters without a piece."""
    rng = random.Random(9)
    words = ["the", "there", "and", "then", "ten", "action", "der", "interest", "in", "on", "est", "er", "e", "a", "aa", "==", "日"]
    return {
        "letters": "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=400_000)),
        "base64": "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=200_000)),
        "words": "".join(rng.choices(words, k=60_000)),
        "one word": "tion" * 50_000 + "th" * 20_000 + "the" * 20_000,
        "few letters": "".join(rng.choices("aeth", k=60_000)),
        "odd": "".join(rng.choices("ab😀\u200b漢字日本語", k=60_000)),
        "spaces": " " * 100_000,
        "spaces and a word": "a" + " " * 100_001 + "b" + " " * 5_000,
    }


@pytest.mark.parametrize("name", long_texts())
def test_long_parts_equal_the_library_in_linear_time(library, name):
    text, began = long_texts()[name], time.monotonic()
    n = text_lengths(PieceModel(PATH), {}, [text])[0]
    ids, _ = Encoder(Transducer(PATH)).encode([text])
    assert time.monotonic() - began < 60
    want = library.encode(text)
    assert n == len(want) and ids.tolist() == want


def test_long_and_short_parts_merge_alike(library, monkeypatch):
    """Everything through the merging of long parts, pairs of all ranks and runs of spaces included."""
    monkeypatch.setattr(token_counts_module, "LONG_PART", 0)
    rng = random.Random(11)
    many = texts() + ["".join(rng.choices("aethinorsd ", k=rng.randint(1, 300))) for _ in range(1500)] + [" " * n for n in range(400)]
    assert text_lengths(PieceModel(PATH), {}, many) == [len(x) for x in library.encode(many)]


def test_runs_of_spaces_equal_the_library(library):
    encoder = Encoder(Transducer(PATH))
    runs = [" " * n + end for n in (*range(70), 255, 256, 1000, 4097) for end in ("", "x", "\n")]
    ids, offsets = encoder.encode(runs)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == library.encode(runs)


def test_broken_bytes_decode_like_the_library(library):
    import numpy as np

    encoder = Encoder(Transducer(PATH))
    ids = [3 + 0xE2, 3 + 0x82, 28705, 3 + 0xC3, 3 + 0xA9]
    decoded = encoder.decode(np.array(ids, np.int32), np.array([0, 5]))[0]
    assert decoded.endswith("é") and "�" in decoded


def test_all_pairs_of_frequent_pieces(library):
    """The arc weights: a pair is free if and only if the library leaves it as it is."""
    import numpy as np

    machine = Transducer(PATH)
    rng = np.random.default_rng(1)
    usable = np.array([i for p, i in machine.model.normal.items() if machine.left[i] > -2 and not machine.blank[i] and "▁" not in p])
    first, second = rng.choice(usable[:4000], 3000), rng.choice(usable[:4000], 3000)
    free = machine.allowed(first, second)
    said = ["\n" + machine.model.pieces[a] + machine.model.pieces[b] for a, b in zip(first, second)]
    want = [x[2:] == [a, b] for x, a, b in zip(library.encode(said), first.tolist(), second.tolist())]
    assert free.tolist() == want


def test_odd_rows(spark, library):
    docs = odd_documents(spark)
    want = sorted((i, len((t or "").encode()), len(library.encode(t or ""))) for i, t in ((r.doc_id or -1, r.text) for r in docs.collect()))
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in token_counts(docs, PATH).collect()) == want
    rows = encode_decode(docs, PATH).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in rows) == sorted((i, n) for i, _, n in want)
    assert {r.doc_id for r in rows if not r.exact} == {7}
    assert all(len(r.ids) == r.n_tokens for r in rows)


def test_empty_table(spark):
    assert token_counts(no_documents(spark), PATH).collect() == []
    assert encode_decode(no_documents(spark), PATH).collect() == []


def test_over_limit(spark):
    assert [r.over_limit for r in token_counts(spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), PATH, limit=2).collect()] == [True]
