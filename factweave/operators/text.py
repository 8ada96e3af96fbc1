"""Text -> triples (TX1 annotate, TX2 extract; E1 with grouping).

The original runs per-row libraries (a statistical chunker, a relation-phrase extractor)
inside map tasks. Here both are column expressions, so they stay in whole-stage codegen:

* TX1 - every sentence of every text, whatever its language (a repeated sentence is a row of its
  own, ``sid`` is its place); tokens are words of letters and marks, numbers, and single other
  characters; Penn tags from a closed-class lexicon plus suffix rules (SYM for characters that are
  neither letter nor number), BIO chunk tags from each token's neighbour.
* TX2 - every token becomes one class character (V verb/auxiliary, D determiner,
  P preposition, C conjunction/pronoun, R adverb, O punctuation, N other), so string offset = token
  offset; a relation is ``V`` or ``V[NDR]*P`` (longest), with the nearest noun phrase
  ``D?N+`` on either side (after the published relation-phrase pattern). Matches do not
  overlap; their token spans come from the running length of earlier matches.

The pattern is anchored with ``\\G``: each match must start where the previous one ended,
which keeps the leading ``(.*?)`` from rescanning the rest of the sentence at every start
position, and a first noun phrase starts at a determiner or at the head of its noun run only, so a
run without a verb is tried once. Both leave the matches as they are and make the search linear:
whole sentences of any length are processed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factweave import constants as C
from factweave.functions import computed_once

SENT_SPLIT = r"[.!?]\s+|\n+"
TOKEN_RE = r"\p{L}[\p{L}\p{M}]*|\p{N}+|[^ \t\n\r\f\x0B\p{L}\p{N}]"
WORD_RE = r"^[\p{L}\p{N}]"
# (arg1 NP)(relation)(arg2 NP) over the class string, preceded by the gap since the last match
TRIPLE_RE_SPARK = r"\G(.*?)(DN++|(?<![DN])N++)(V(?:[NDR]*+P)?)(D?N++)"
TRIPLE_RE_PLAIN = r"(.*?)(D?N+)(V(?:[NDR]*P)?)(D?N+)"


def _words(*tags: str) -> list[str]:
    return sorted(w for w, t in C.LEXICON.items()
                  if t in tags or any(t.startswith(p[:-1]) for p in tags if p.endswith("*")))


CLASS_WORDS = {
    "D": _words("DT"),
    "P": _words("IN", "TO"),
    "C": _words("CC", "PRP"),
    "V": _words("VB*", "MD"),
    "R": _words("RB"),
}


# tokens are looked at one by one, so known words are found in hash sets and patterns are left to what plain characters do not decide
LETTERS = [chr(c) for c in range(ord("a"), ord("z") + 1)]
DIGITS = [str(d) for d in range(10)]
PENN_WORDS = {tag: sorted(w for w, x in C.LEXICON.items() if x == tag) for tag in dict.fromkeys(C.LEXICON.values())}


def no_word(t: Column) -> Column:
    """The token begins with neither a letter nor a number."""
    return F.when(F.substring(t, 1, 1).isin(*LETTERS, *DIGITS), F.lit(False)).otherwise(~t.rlike(WORD_RE))


def looked_up(t: Column, lists: dict[str, list[str]], other: Column) -> Column:
    """The key of the list that holds the token, else ``other``; most tokens are in none."""
    e = None
    for k, words in lists.items():
        e = F.when(t.isin(*words), F.lit(k)) if e is None else e.when(t.isin(*words), F.lit(k))
    return F.when(t.isin(*[w for words in lists.values() for w in words]), e).otherwise(other)


def token_class(t: Column) -> Column:
    """One class character per (lower-case) token."""
    return looked_up(t, CLASS_WORDS, F.when(no_word(t), F.lit("O")).when(t.endswith("ly"), F.lit("R")).otherwise(F.lit("N")))


def penn_tag(t: Column) -> Column:
    """Penn tag: lexicon first, then suffix rules."""
    number = F.substring(t, 1, 1).isin(*DIGITS) & t.rlike("^[0-9]+$")
    return looked_up(t, PENN_WORDS, F.when(no_word(t), F.lit("SYM")).when(number, F.lit("CD")).when(t.endswith("ly"), F.lit("RB"))
                     .when(t.endswith("ing"), F.lit("VBG")).when(t.endswith("ed"), F.lit("VBD"))
                     .when(t.endswith("s"), F.lit("NNS")).otherwise(F.lit("NN")))


def chunk_type(tag: Column) -> Column:
    return (F.when(tag.isin("DT", "NN", "NNS", "CD", "PRP"), F.lit("NP"))
            .when(tag.startswith("VB") | tag.isin("MD", "RB"), F.lit("VP"))
            .when(tag.isin("IN", "TO"), F.lit("PP")))


def sentences(docs: DataFrame, text_col: str = "text", id_cols=("doc_id",), url_col: str | None = "source") -> DataFrame:
    """(id, sid, sentence) rows of every document, whole texts; ``sid`` is the sentence's place."""
    keep = [*id_cols] + ([url_col] if url_col else [])
    whole = computed_once(docs.select(*keep, F.col(text_col).alias("_text")), _sents=F.split("_text", SENT_SPLIT))
    return whole.select(*keep, F.posexplode("_sents").alias("sid", "sentence"))


def tokenize(sents: DataFrame) -> DataFrame:
    toks = F.regexp_extract_all(F.lower("sentence"), F.lit(TOKEN_RE), 0)
    return computed_once(sents, tokens=toks).filter(F.size("tokens") > 0)


def with_chunks(df: DataFrame, postags: str = "postags", out: str = "chunks") -> DataFrame:
    """BIO chunk tags from POS tags: B- when the chunk type differs from the previous token's.

    The look-back zips the chunk types, formed once, with a copy shifted by one, so the cost stays linear in
    sentence length.
    """
    x = computed_once(df, _ct=F.transform(postags, chunk_type))
    prev = F.concat(F.array(F.lit(None).cast("string")), F.slice("_ct", 1, F.greatest(F.size("_ct") - 1, F.lit(0))))
    tags = F.zip_with("_ct", prev, lambda c, p: F.when(c.isNull(), F.lit("O")).otherwise(F.concat(
        F.when(p.isNull() | (p != c), F.lit("B-")).otherwise(F.lit("I-")), c)))
    return x.withColumn(out, tags).drop("_ct")


def annotate(sents: DataFrame) -> DataFrame:
    """TX1: tokens, POS tags and BIO chunk tags (arrays)."""
    return with_chunks(computed_once(tokenize(sents), postags=F.transform("tokens", penn_tag)))


def extract(sents: DataFrame, url_col: str = "url") -> DataFrame:
    """TX2: one row per triple with token spans; sentences without a match yield nothing."""
    t = computed_once(tokenize(sents), tags=F.array_join(F.transform("tokens", token_class), ""))
    # the search runs once; the groups are taken from each match
    t = computed_once(t, m=F.regexp_extract_all("tags", F.lit(TRIPLE_RE_SPARK), 0)).filter(F.size("m") > 0)
    t = t.withColumn("lens", F.transform("m", F.length))
    x = t.select("*", F.posexplode("m").alias("k", "mm"))
    x = x.withColumns({f"g{i}": F.length(F.regexp_extract("mm", TRIPLE_RE_SPARK, i)) for i in range(1, 5)})
    before = F.aggregate(F.slice("lens", 1, F.col("k")), F.lit(0), lambda a, b: a + b)
    a1s = before + F.col("g1")
    l1, l2, l3 = F.col("g2"), F.col("g3"), F.col("g4")
    keep = [c for c in x.columns if c not in ("m", "lens", "mm", "tags", "k", "g1", "g2", "g3", "g4")]
    return x.select(*keep, a1s.cast("int").alias("arg1_start"), l1.cast("int").alias("arg1_len"),
                    (a1s + l1).cast("int").alias("rel_start"), l2.cast("int").alias("rel_len"),
                    (a1s + l1 + l2).cast("int").alias("arg2_start"), l3.cast("int").alias("arg2_len"))


def document_extractions(docs: DataFrame) -> DataFrame:
    """E1 front half: documents -> extraction rows (tokens, spans, url, corpus), all languages."""
    s = sentences(docs.withColumn("url", F.concat_ws("/", "source", F.col("doc_id").cast("string"))),
                  id_cols=("doc_id",), url_col="url")
    return extract(s).withColumn("corpus", F.lit("documents"))
