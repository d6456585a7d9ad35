"""Encoding and counting against the libraries themselves."""
import hashlib
import random
from array import array

import pytest
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer, models, normalizers

from conftest_llm import by_id
from early_warning.llm import encode, token_count
from early_warning.llm.pieces import ChunkTable, chunks, stays_in_chunk, vocabulary

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def unigram():
    t = Tokenizer(models.Unigram([tuple(p) for p in vocabulary(MODEL)], unk_id=0, byte_fallback=True))
    t.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    return t


def texts():
    rng = random.Random(2)
    alphabet = "ab e▁ \n\t\0é日🎉<s>/x0A'.,A  "
    return ["", " ", "  ", "▁", "a", " a", "a ", "a  b", "<s> </s> <unk> <0x0A>", "x" * 300, "日本" * 200] + [
        "".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(400)]


def test_encoder_is_the_library(library):
    for own in (encode.Encoder(MODEL), _tiny(encode.Encoder(MODEL))):
        got = own.encode(texts()) + own.encode(texts())
        want = [array("I", x).tobytes() for x in library.encode(texts(), add_bos=True, add_eos=True)]
        assert got == want + want


def _tiny(own):
    """An encoder whose table overflows all the time and stores no long chunks."""
    own.table.most, own.table.longest = 7, 3
    return own


def digests(library, text):
    ids = library.encode(text or "", add_bos=True, add_eos=True)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return len(ids), sha(b"".join(i.to_bytes(4, "little") for i in ids)), sha(library.decode(ids).encode())


def check(library, docs):
    columns = ("n_tokens", "ids_sha256", "decoded_sha256")
    want = sorted(((r.doc_id, *digests(library, r.text)) for r in docs.collect()), key=repr)
    assert by_id(encode.encode_texts(docs, MODEL, columns=columns), *columns) == want


def test_query(spark, library, edges, wide, nothing, sf_dir):
    check(library, edges)
    check(library, wide)
    check(library, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert encode.encode_texts(nothing, MODEL).count() == 0


def test_real_outputs(spark, library):
    docs = spark.createDataFrame([(1, "Hello  world\n")], "doc_id long, text string")
    r = encode.encode_texts(docs, MODEL).first()
    assert r.ids == library.encode("Hello  world\n", add_bos=True, add_eos=True) and r.decoded == "Hello  world\n"


def test_chunks_rejoin():
    for t in texts():
        joined = "".join(" " + c for c in chunks(t))
        assert joined == (" " + t.replace("▁", " ") if t else "")
    assert stays_in_chunk(["▁a", "▁▁", "b"]) and not stays_in_chunk(["a▁b"])


def test_count_is_the_library(unigram):
    own = token_count.Counter(vocabulary(MODEL))
    want = [(len(unigram.encode(t, add_special_tokens=False).ids),) for t in texts()]
    assert own.count(texts()) == want
    own.table.most = 5
    assert own.count(texts()) == want


def test_ties_follow_the_library():
    rng = random.Random(4)
    for _ in range(40):
        pieces = {"▁", *(("▁" if rng.random() < .3 else "") + "".join(rng.choice("abc") for _ in range(rng.randrange(1, 4))) for _ in range(12))}
        vocab = [("<unk>", 0.0)] + [(p, -float(rng.randrange(1, 4))) for p in sorted(pieces)] + [(f"<0x{b:02X}>", -9.0) for b in range(256)]
        library = Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=True))
        library.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
        own = token_count.Counter(vocab)
        some = ["".join(rng.choice("abcd é ") for _ in range(20)) for _ in range(20)]
        assert own.count(some) == [(len(library.encode(t, add_special_tokens=False).ids),) for t in some]


def test_count_query(spark, unigram, edges, wide, nothing, sf_dir):
    for docs in (edges, wide, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        want = sorted(((r.doc_id, len(unigram.encode(r.text or "", add_special_tokens=False).ids) if r.text else 0) for r in docs.collect()), key=repr)
        assert by_id(token_count.count_tokens(docs, MODEL), "n_tokens") == want
    assert token_count.count_tokens(nothing, MODEL).count() == 0


def test_vocabulary_across_markers_is_refused():
    with pytest.raises(ValueError):
        token_count.Counter([("<unk>", 0.0), ("a▁b", -1.0)])


def test_table_stays_bounded():
    made = []
    table = ChunkTable(lambda new: made.extend(new) or [len(c) for c in new], most=3, longest=4)
    assert table.of([["a", "bb", "a"], ["ccccc", "bb"]]) == [[1, 2, 1], [5, 2]]
    assert table.of([["d", "e", "ccccc"]]) == [[1, 1, 5]] and len(table) <= 3 and made.count("ccccc") == 2
