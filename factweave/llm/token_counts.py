"""Token counts: batch encoding in Arrow functions that return lengths only.

Batches are balanced by bytes (about 12 MB of text at once, whatever the number of rows), and texts
are split at safe boundaries (``tokenizing``), so one very long text costs no more memory than its
own bytes. One pass over the table, no shuffle; memory per worker is a batch plus a bounded cache.

Defined results: a null text counts as empty (0 bytes, 0 tokens); repeated rows give repeated rows;
an empty table gives an empty result; other columns of the input are not read; a null id stays null.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.llm.common import TOKEN_BYTES, byte_chunks, map_text
from factweave.llm.tokenizing import pieces_for


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text."""
    def count(batches):
        encoder = pieces_for(tokenizer_path, True)
        for rows, texts in byte_chunks(batches, "text", TOKEN_BYTES):
            n = encoder.lengths(texts)
            yield rows.column(0), pa.array(map(len, texts), pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())

    return map_text(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), count,
                    "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
