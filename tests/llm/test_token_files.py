import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from brindle.llm import bpe_ids
from brindle.llm import token_files as op
from tests.llm.common import EDGES, documents, empty


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe_ids.default_path())


def test_ids_are_the_library_s(library):
    r = random.Random(1)
    parts = [" ", " ", "  ", "a", "B", "é", "'s", "'", "1", "2.", ",", "\n", "\t", "　", "́", "世", "<|endoftext|>", "x_y", "!?", "\r\n", "\x85", "᠎", "ª", "²", "\x1c", ".\nAb"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(16))) for _ in range(20000)] + ["", " ", "a" * 5000]
    e = bpe_ids.Encoder(bpe_ids.default_path())
    got = [np.frombuffer(b, e.dtype).tolist() for b in e.encode(texts)]
    assert got == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_added_tokens_are_the_library_s(library):
    e = bpe_ids.Encoder(bpe_ids.default_path())
    parts = [x for t in library.get_added_tokens_decoder().values() for x in (t.content, t.content[:-1], t.content[1:])]
    assert parts
    texts = ["hello <|endoftext|> world", *parts, *(a + t + b for t in parts for a in ("", " ", "x", "x ", "\n", "x.", " x  ", "<", "é") for b in ("", " ", "y", " y", "\n", ".", "  y", "|>", "ß"))]
    texts += [t + t for t in parts] + [f"a{t} {t}b{t}" for t in parts]
    assert [np.frombuffer(b, e.dtype).tolist() for b in e.encode(texts)] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert np.frombuffer(e.encode(texts[:1])[0], e.dtype).tolist() == [31373, 220, 50256, 995]


def test_a_full_memo_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe_ids.Encoder, "entries", 3)
    monkeypatch.setattr(bpe_ids.Encoder, "kept", 2)
    e = bpe_ids.Encoder(bpe_ids.default_path())
    for text in ["one two three four", "five six", "one six"]:
        assert np.frombuffer(e.encode([text])[0], e.dtype).tolist() == library.encode(text, add_special_tokens=False).ids


def expected(library, rows):
    out, start = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [op.END_ID], dtype="<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files_hold_all_documents_in_order(spark, tmp_path, library):
    manifest = op.write_token_files(documents(spark, EDGES), str(tmp_path / "t"), bpe_ids.default_path())
    got = op.read_token_files(spark, str(tmp_path / "t"), manifest).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(library, EDGES)
    assert not [p for p in (tmp_path / "t").iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]


def test_files_can_be_mapped_alone(spark, tmp_path, library):
    folder = f"file://{tmp_path}/u"
    manifest = op.write_token_files(documents(spark, [(1, "a b"), (2, "c")]), folder, bpe_ids.default_path())
    files = [op.TokenFile(folder, m.part) for m in manifest.orderBy("base").collect()]
    ids = [f.ids(i).tolist() for f in files for i in range(len(f))]
    assert ids == [library.encode(t).ids + [2] for t in ("a b", "c")]


def test_empty(spark, tmp_path):
    manifest = op.write_token_files(empty(spark), str(tmp_path / "e"), bpe_ids.default_path())
    assert op.read_token_files(spark, str(tmp_path / "e"), manifest).collect() == []
