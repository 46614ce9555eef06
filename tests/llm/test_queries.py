"""The registered queries on the smallest tables: against brute force or SQL, and their columns."""

import hashlib
import os
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import test_pii
import test_quality
import test_repeats
import test_simhash
import test_url_filter
from adtally.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

COLUMNS = {
    "op1_segmented_hosts": [("page_id", "bigint"), ("host", "string"), ("path", "string"), ("rule", "string"), ("verdict", "string")],
    "op3_cost_balanced_packing": [("doc_id", "bigint"), ("start", "bigint"), ("length", "bigint"), ("ids_crc32", "bigint"), ("doc_tokens", "bigint"), ("sequence_id", "bigint"), ("offset", "bigint")],
    "op4_dictionary_warc": [("page_id", "bigint"), ("payload_bytes", "bigint"), ("payload_digest", "string"), ("record_type", "string"), ("refers_to", "bigint")],
    "op5_decision_list": [("doc_id", "bigint"), ("n_words", "bigint"), ("word_chars", "bigint"), ("n_symbols", "bigint"), ("n_dup_lines", "bigint"), ("n_repeat_words", "bigint"), ("base_failed", "boolean"), ("kept", "boolean")],
    "op6_checked_personal_data": [("doc_id", "bigint"), ("n_email", "bigint"), ("n_ip", "bigint"), ("n_card", "bigint"), ("n_phone", "bigint"), ("base_sha256", "string"), ("spans", "string")],
    "op7_golay_simhash": [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")],
    "op8_learned_partitions": [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")],
    "op9_bitmask_language": [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")],
    "op10_merged_suffix_runs": [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"), ("kept_sha256", "string")],
}


@pytest.fixture(scope="module")
def found(spark):
    out = {}
    for name, want in COLUMNS.items():
        df = queries.QUERIES[name](spark, SF)
        assert df.dtypes[: len(want)] == want
        out[name] = df.collect()
    return out


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_one_row_per_document(found, texts):
    for name in COLUMNS:
        if name.split("_")[0] in ("op5", "op6", "op7", "op9", "op10"):
            assert sorted(r.doc_id for r in found[name]) == sorted(texts)


def test_packing(found, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in texts.items()}
    covered = Counter()
    for r in found["op3_cost_balanced_packing"]:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and zlib.crc32(own[r.start : r.start + r.length].tobytes()) == r.ids_crc32
        covered[r.doc_id] += r.length
    assert covered == {i: len(v) for i, v in ids.items()}


def test_statistics(found, texts):
    for r in found["op5_decision_list"]:
        assert tuple(r[1:7]) == test_quality.brute(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_personal_data(found, texts):
    for r in found["op6_checked_personal_data"]:
        base = test_pii.brute(texts[r.doc_id])
        counts = Counter(k for k, *_ in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts[k] for k in ("email", "ip", "card", "phone"))
        joined = ",".join("%s:%d:%d" % s for s in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and s.split(":")[0] in ("email", "ip", "card", "phone")] == [s for s in joined.split(",") if s]


def test_simhash_components(found, texts):
    rows = found["op7_golay_simhash"]
    fps = [test_simhash.brute_fingerprint(texts[r.doc_id]) for r in rows]
    assert [r.fingerprint for r in rows] == [f"{f:016x}" for f in fps]
    assert [r.component_id for r in rows] == test_simhash.brute_components([r.doc_id for r in rows], fps)


def test_removed_repeats(found, texts):
    want = dict(zip(texts, test_repeats.brute(list(texts.values()))))
    for r in found["op10_merged_suffix_runs"]:
        n_bytes, n_removed, n_spans, kept = want[r.doc_id]
        assert tuple(r[1:]) == (n_bytes, n_removed, n_spans, hashlib.sha256(kept).hexdigest())


def test_urls(spark, found):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert sorted(r.page_id for r in found["op1_segmented_hosts"]) == sorted(urls)
    for r in found["op1_segmented_hosts"]:
        host, path = test_url_filter.split(urls[r.page_id])
        rule, verdict = test_url_filter.rule_for(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule) and (rule is None or r.verdict == verdict)


def test_language_split(found):
    for r in found["op9_bitmask_language"]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_gives_the_same(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    res = con.execute(queries.ORACLES[name])
    at = {d[0]: i for i, d in enumerate(res.description)}
    assert sorted(at) == columns
    want = sorted((tuple(r[at[c]] for c in columns) for r in res.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == want
