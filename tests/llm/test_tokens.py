import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from offerlens.llm import bpe, token_files
from offerlens.llm import common as c
from offerlens.llm.queries import VOCABULARIES
from tests.llm.helpers import ODD_TEXTS, documents, prose

BYTE, WORD = f"{VOCABULARIES}/byte_bpe_50k.json", f"{VOCABULARIES}/word_bpe_49k.json"
byte_tokenizer, word_tokenizer = Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)
encoder = bpe.Encoder(bpe.Vocabulary(open(BYTE).read()))
words = token_files.WordEncoder(open(WORD).read())
TEXT = st.text(st.one_of(st.sampled_from("ab 'strelmvd\n\t\r\x0b\x0c\x1c\x85\xa0 　́éÉΣς12²ß漢\U0001f600<|>!.-="), st.characters(exclude_categories=["Cs", "Cn"])))
EDGE = [" " * 300, "a" * 1000, "=" * 700 + "-" * 300, "ab" * 500, "I'll we've 'tis 's's", "x  y   \n\n z \n", "<|endoftext|>a <|endoftext|><|endoftext|",
        "<|startoftext|> b<|endoftext|>", "<|ENDOFTEXT|> A.b, C.; é. É! x?!", "\xa0" * 200, "é́ ́", "don'T DON'T ΑΣ ΟΔΟΣ", "the " * 40_000, "\x1c\x1d a\x85b"]


def all_ids(text):
    return [i for ids in encoder.encode(text) for i in ids.tolist()]


def same(text):
    want = byte_tokenizer.encode(text, add_special_tokens=False).ids
    assert all_ids(text) == want
    assert "".join(bpe.decode(encoder.vocabulary, encoder.encode(text))) == byte_tokenizer.decode(want, skip_special_tokens=False)
    data = np.frombuffer((text + text).encode(), np.uint8)
    half = len(data) // 2
    got, counts = words.encode(data, np.array([0, half, half, 2 * half]))
    want = word_tokenizer.encode(text, add_special_tokens=False).ids
    assert got.tolist() == want + want and counts.tolist() == [len(want), 0, len(want)]


def test_edges():
    for text in [*EDGE, *ODD_TEXTS]:
        same(text or "")


def same_words(text):
    """Ids of whole texts in slices with and without a special token's mark."""
    for around in ("", "<|"):
        whole = f"{text} {around}"
        data = np.frombuffer(whole.encode(), np.uint8)
        assert words.encode(data, np.array([0, len(data)]))[0].tolist() == word_tokenizer.encode(whole, add_special_tokens=False).ids, repr(whole)


def test_words_that_change_when_lowered_or_composed():
    for text in ["TARİHİ, BÜYÜK ŞEHİRLERİ.", "İ! İ, aİ; İ", "T\u0308 W\u030a Y\u030a H\u0331 J\u030c aT\u0308! T\u0308,", "ΟΔΥΣΣΕΥΣ. Σ, ΆΣ!", "A\u0301B E\u0301. E\u0301"]:
        same_words(text)


def test_a_hundred_thousand_words_of_turkish_greek_and_combining_characters():
    rng = random.Random(4)
    letters = "abtwyhjTWYHJIİıiŞşĞğÜüÖöÇçΑΆΣσςΟΔοδ\u0301\u0307\u0308\u030a\u030c\u0331\u0345.,!'-12ẞßǅ"
    for _ in range(400):
        same_words(" ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(250)))


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_any_text(text):
    same(text)


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("abthe ing-=_. éß"), min_size=0, max_size=300), st.integers(1, 40))
def test_stream_equals_merges(text, size):
    data = text.encode()
    got = [i for ids in encoder.vocabulary.stream(data[k: k + size] for k in range(0, len(data), size)) for i in ids]
    assert got == encoder.vocabulary.merge(data)


def test_stream_keeps_a_bounded_window():
    emitted = list(encoder.vocabulary.stream(bytes([x]) for x in b"internationalization" * 400))
    assert len(emitted) > 20  # tokens leave while the piece is still arriving


@settings(max_examples=150, deadline=None)
@given(TEXT, st.integers(4, 12))
def test_blocks_cut_nothing(text, block):
    assert [p for ps in bpe.blocks_of_pieces(text, block) for p in ps] == bpe.PIECE.findall(text)


@given(st.binary(max_size=60), st.integers(1, 5))
def test_decoder_on_broken_bytes(data, size):
    ids = np.array([encoder.vocabulary.byte_id[b] for b in data], np.uint16)
    got = "".join(bpe.decode(encoder.vocabulary, (ids[k: k + size] for k in range(0, len(ids), size))))
    assert got == byte_tokenizer.decode(ids.tolist(), skip_special_tokens=False)


def rows():
    rng = random.Random(3)
    out = [(i, prose(rng, rng.randint(0, 80)), "en", "a") for i in rng.sample(range(10_000), 150)]
    return out + [(20_000 + k, t, None, None) for k, t in enumerate([*ODD_TEXTS, *EDGE])] + [(7, "dup", None, None)] * 3 + [(None, "none", None, None)]


def test_round_trip_query(spark):
    got = bpe.round_trip(documents(spark, rows()), BYTE).drop("decoded_chars").collect()
    want = []
    for i, t, *_ in rows():
        ids = byte_tokenizer.encode(t or "", add_special_tokens=False).ids
        text = byte_tokenizer.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert bpe.round_trip(documents(spark, []), BYTE).count() == 0


def test_token_files(spark):
    path = c.shared_folder(spark)
    token_files.write_tokens(documents(spark, rows()), WORD, path, files=5)
    got = sorted(map(tuple, token_files.token_digests(spark, path).collect()), key=lambda r: r[1])
    want, start = [], 0
    for i, t, *_ in sorted(rows(), key=lambda r: (r[0] is not None, r[0])):
        ids = word_tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    stored = token_files.read_tokens(spark, path).filter("doc_id = 20003")
    assert "EqualTo(doc_id,20003)" in stored._jdf.queryExecution().toString()
    assert stored.count() == 1


def test_token_files_of_an_empty_table(spark):
    path = c.shared_folder(spark)
    token_files.write_tokens(documents(spark, []), WORD, path)
    assert token_files.token_digests(spark, path).count() == 0


def test_orc_layout(spark):
    import glob

    from pyarrow import orc

    path = c.shared_folder(spark)
    token_files.write_tokens(documents(spark, [(i, "a b c", None, None) for i in range(5000)]), WORD, path, files=2)
    files = [orc.ORCFile(f) for f in glob.glob(path.removeprefix("file:") + "/part-*.orc")]
    assert sum(f.nrows for f in files) == 5000 and all(f.row_index_stride == token_files.ROW_STRIDE for f in files)
    assert all(f.nstripes > 0 for f in files)


def test_a_merge_looks_up_only_the_pairs_beside_it():
    class Counted(dict):
        asked = 0

        def get(self, *args):
            self.asked += 1
            return super().get(*args)

    vocabulary = bpe.Vocabulary(open(BYTE).read())
    vocabulary.rank = Counted(vocabulary.rank)
    piece = b" internationalisation"
    ids = vocabulary.merge(piece)
    assert ids == byte_tokenizer.encode(piece.decode(), add_special_tokens=False).ids
    assert vocabulary.rank.asked <= len(piece) - 1 + 2 * (len(piece) - len(ids))
