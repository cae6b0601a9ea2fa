"""Registered queries of the operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers

from adspark.llm import bpe, langid, linededup, neardup, packing, phrases, quality, secrets, sharding, spans, topk, variants, warc
from adspark.llm.common import documents, embeddings, pages

BYTE_VOCAB = public_tokenizers.path("byte_bpe_50k.json")
WORD_VOCAB = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")

QUERIES = {
    "op1_pivot_topk": lambda s, d: topk.op1(embeddings(s, d)),
    "op2_language_id": lambda s, d: langid.op2(documents(s, d)),
    "op3_best_fit_packing": lambda s, d: packing.best_fit_packing(documents(s, d), BYTE_VOCAB),
    "op4_host_quality": lambda s, d: quality.op4(documents(s, d)),
    "op5_site_lines": lambda s, d: linededup.op5(documents(s, d)),
    "op6_bpe_codec": lambda s, d: bpe.encode_documents(documents(s, d), WORD_VOCAB, digests=True),
    "op7_warc_zstd": lambda s, d: warc.archive_round_trip(s, pages(s, d)),
    "op8_secret_scan": lambda s, d: secrets.scan(documents(s, d)),
    "op9_jump_shards": lambda s, d: sharding.shard_documents(documents(s, d)),
    "op10_jaccard_join": lambda s, d: neardup.near_duplicates(documents(s, d)),
    "op11_spelling_variants": lambda s, d: variants.group_variants(documents(s, d)),
    "op12_phrase_mining": lambda s, d: phrases.mine(documents(s, d)),
    "op13_piece_spans": lambda s, d: spans.encode_documents(documents(s, d), PIECE_MODEL, digests=True),
}

ORACLE = {
    "op1_pivot_topk": topk.ORACLE,
    "op4_host_quality": quality.ORACLE,
    "op5_site_lines": linededup.ORACLE,
    "op7_warc_zstd": warc.ORACLE,
    "op12_phrase_mining": phrases.ORACLE,
}
