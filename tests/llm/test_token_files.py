"""Token files: the code round-trips, files hold all documents in order."""

import zlib

import numpy as np
from auditlens.llm import token_files
from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=50))
def test_numbers_round_trip(numbers):
    control, data = token_files.encode_numbers(np.array(numbers, np.uint32))
    assert len(control) == -(-len(numbers) // 4)
    assert token_files.decode_numbers(control, data, len(numbers)).tolist() == numbers


def test_files_round_trip(spark, docs_of, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(5, "the cat the cat the"), (2, None), (9, ""), (2, "twice"), (None, "no id"), (-3, "minus " * 400), (5, "the cat the cat the")]
    folder = token_files.write_token_files(docs_of(rows), path, str(tmp_path / "t"), files=3)
    got = token_files.read_token_files(spark, folder).collect()
    t = Tokenizer.from_file(path)
    want = {(i, tuple([*t.encode(x or "", add_special_tokens=False).ids, 2])) for i, x in rows}
    read = sorted(got, key=lambda r: r.start)
    assert {(r.doc_id, tuple(np.frombuffer(bytes(r.ids), "<u4").tolist())) for r in read} == want and len(read) == len(rows)
    assert [r.doc_id for r in read] == [None, -3, 2, 2, 5, 5, 9]
    at = 0
    for r in read:
        assert r.start == at and r.n_tokens * 4 == len(r.ids) and r.ids_crc32 == zlib.crc32(bytes(r.ids))
        at += r.n_tokens
    ranks = spark.read.parquet(f"{folder}/vocabulary").orderBy("rank").collect()
    assert [r.n for r in ranks] == sorted((r.n for r in ranks), reverse=True) and sum(r.n for r in ranks) == at


def test_empty_table(spark, docs_of, tmp_path):
    import public_tokenizers
    folder = token_files.write_token_files(docs_of([(1, "x")]).where("false"), public_tokenizers.path("byte_bpe_50k.json"),
                                           str(tmp_path / "t"))
    assert token_files.read_token_files(spark, folder).count() == 0
