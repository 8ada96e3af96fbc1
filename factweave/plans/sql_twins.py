"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each twin restates the fixture views of ``sources.fixtures`` and the operator's semantics
in plain SQL over the driver's pre-registered views. Where an operator caps or samples (AG2, AG6),
the oracle uses straightforward windows (``row_number``) and the Spark side the skew-safe cap; both
keep the first n rows of each key in the same md5 order.
"""

from __future__ import annotations

from factweave import constants as C
from factweave.operators.score import PREPOSITIONS


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def arr(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


EXCEPTIONS = "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in C.STEM_EXCEPTIONS.items()) + "}"


def stem(lst: str) -> str:
    known = f"map_extract({EXCEPTIONS}, t)[1]"
    cut = r"""CASE WHEN regexp_matches(t, '^\p{L}{2,}ies$') THEN left(t, length(t) - 3) || 'y'
      WHEN regexp_matches(t, '^(\p{L}+(ss|sh|ch|zz)|\p{L}{2,}x)es$') THEN left(t, length(t) - 2)
      WHEN regexp_matches(t, '^\p{L}{3,}s$') AND NOT regexp_matches(t, '[sui]s$') THEN left(t, length(t) - 1) ELSE t END"""
    return f"list_transform(list_transform({lst}, lambda t: coalesce({known}, {cut})), lambda t: coalesce({known}, t))"


def norm_arg(lst: str) -> str:
    return f"array_to_string({stem(f'list_transform({lst}, lambda t: lower(t))')}, ' ')"


def norm_rel(lst: str) -> str:
    low = f"list_transform({lst}, lambda t: lower(t))"
    kept = f"list_filter({low}, lambda t: NOT list_contains({arr(C.REL_DROP_WORDS)}, t))"
    return f"array_to_string({stem(kept)}, ' ')"


def prefixed(x: str) -> str:
    return f"coalesce(length(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '~')"


def row_hash(*xs: str) -> str:
    return f"md5(concat_ws('|', {', '.join(prefixed(x) for x in xs)}))"


INST_ID = row_hash(f"array_to_string(list_transform(tokens, lambda t: {prefixed('t')}), ',')", "arg1_start", "arg1_len", "rel_start",
                   "rel_len", "arg2_start", "arg2_len", "url", "corpus", "CAST(confidence AS DECIMAL(9,6))")


def sl(tokens: str, start: str, length: str) -> str:
    return f"list_slice({tokens}, {start} + 1, {start} + {length})"


PART_TYPES = """list_sort(CASE WHEN p_partkey % 13 = 0 THEN ['/base/catalog', '/tv/tv_subject']
  ELSE list_concat(
    CASE WHEN p_partkey % 3 = 0 THEN ['/size/s' || (p_size % 10), '/brand/b' || (CAST(split_part(p_brand, '#', 2) AS INTEGER) % 7), '/base/catalog']
         ELSE ['/size/s' || (p_size % 10), '/brand/b' || (CAST(split_part(p_brand, '#', 2) AS INTEGER) % 7)] END,
    CASE WHEN p_partkey % 17 = 0 THEN ['/misc/unknown'] ELSE []::VARCHAR[] END) END)"""

SUPPLIER_TYPES = "list_sort(['/business/supplier', '/location/n' || s_nationkey])"


def conf_sql() -> str:
    n = "len(tokens)"
    rel_last = "lower(tokens[rel_start + rel_len])"
    a1 = f"array_to_string({sl('tokens', 'arg1_start', 'arg1_len')}, ' ')"
    a2 = f"array_to_string({sl('tokens', 'arg2_start', 'arg2_len')}, ' ')"
    feats = {
        "covers_sentence": f"(arg1_len + rel_len + arg2_len) = {n}",
        "starts_sentence": "arg1_start = 0",
        "short_sentence": f"{n} <= 10",
        "long_sentence": f"{n} > 20",
        "rel_ends_prep": f"{rel_last} IN ({', '.join(q(p) for p in PREPOSITIONS)})",
        "rel_single_verb": "rel_len = 1",
        "arg2_ends_sentence": f"(arg2_start + arg2_len) = {n}",
        "arg_has_digit": f"(regexp_matches({a1}, '[0-9]') OR regexp_matches({a2}, '[0-9]'))",
    }
    z = f"CAST({C.CONF_INTERCEPT!r} AS DOUBLE)"
    for name, w in C.CONF_WEIGHTS.items():
        z = f"({z} + CASE WHEN {feats[name]} THEN CAST({w!r} AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END)"
    valid = " AND ".join(f"{p}_start >= 0 AND {p}_len > 0 AND {p}_start + {p}_len <= {n}" for p in ("arg1", "rel", "arg2"))
    p = f"(CAST(1.0 AS DOUBLE) / (CAST(1.0 AS DOUBLE) + exp(-{z})))"
    return f"CASE WHEN {valid} THEN CAST(CAST({p} AS DECIMAL(9,6)) AS DOUBLE) END"


A1 = "string_split(p_name || ' ' || p_brand, ' ')"
RL = "string_split('is supplied by ' || n_name, ' ')"
A2 = "string_split(s_name, ' ')"

EXTRACTIONS = f"""ex_raw AS (
  SELECT l_orderkey, l_linenumber,
    list_concat(list_concat({A1}, {RL}), {A2}) AS tokens,
    0 AS arg1_start, CAST(len({A1}) AS INTEGER) AS arg1_len,
    CAST(len({A1}) AS INTEGER) AS rel_start, CAST(len({RL}) AS INTEGER) AS rel_len,
    CAST(len({A1}) + len({RL}) AS INTEGER) AS arg2_start, CAST(len({A2}) AS INTEGER) AS arg2_len,
    'http://orders.example/' || CAST(l_orderkey AS VARCHAR) || '#' || CAST(l_linenumber AS VARCHAR) AS url,
    'lineitem' AS corpus,
    CASE WHEN p_partkey % 5 <> 0 THEN 'm.' || CAST(p_partkey AS VARCHAR) END AS arg1_fbid,
    p_name || ' ' || p_brand AS arg1_name,
    p_partkey % 7 AS arg1_inlinks,
    CASE WHEN p_partkey % 5 <> 0 THEN {PART_TYPES} ELSE []::VARCHAR[] END AS arg1_types,
    CASE WHEN s_suppkey % 3 <> 0 THEN 's.' || CAST(s_suppkey AS VARCHAR) END AS arg2_fbid,
    s_name AS arg2_name,
    s_suppkey % 4 AS arg2_inlinks,
    CASE WHEN s_suppkey % 3 <> 0 THEN {SUPPLIER_TYPES} ELSE []::VARCHAR[] END AS arg2_types
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
),
ex AS (
  SELECT *,
    {norm_arg(sl('tokens', 'arg1_start', 'arg1_len'))} AS arg1,
    {norm_rel(sl('tokens', 'rel_start', 'rel_len'))} AS rel,
    {norm_arg(sl('tokens', 'arg2_start', 'arg2_len'))} AS arg2,
    {conf_sql()} AS confidence
  FROM ex_raw
),
ex_i AS (
  SELECT *, {INST_ID} AS inst_id
  FROM ex
)"""

TUPLES = """tuples AS (
  SELECT arg1, arg1_fbid, arg1_types, rel, arg2, arg2_fbid, arg2_types,
         CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) AS row_id
  FROM ex
)"""

INSTANCES = """inst AS (
  SELECT DISTINCT arg1, rel, arg2, tokens, arg1_start, arg1_len, rel_start, rel_len, arg2_start, arg2_len,
         url, corpus, confidence, inst_id
  FROM ex_i
)"""

GROUPS = """grp AS (
  SELECT arg1, rel, arg2, count(*) AS n_instances, count(DISTINCT url) AS n_urls,
         max(confidence) AS max_conf, min(confidence) AS min_conf
  FROM inst GROUP BY arg1, rel, arg2
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---------------------------------------------------------------------------
# typing (E2)
# ---------------------------------------------------------------------------

TYPE_DIM = f"""tdim AS (
  SELECT CASE WHEN type LIKE '/size/s%' THEN CAST(regexp_extract(regexp_extract(type, '[^/]+$'), '[0-9]+') AS INTEGER)
              WHEN type LIKE '/brand/b%' THEN 100 + CAST(regexp_extract(regexp_extract(type, '[^/]+$'), '[0-9]+') AS INTEGER)
              WHEN type = '/base/catalog' THEN 200
              WHEN type = '/tv/tv_subject' THEN 201
              WHEN type = '/business/supplier' THEN 300
              ELSE 400 + CAST(regexp_extract(regexp_extract(type, '[^/]+$'), '[0-9]+') AS INTEGER) END AS enum,
         type, CAST(count(*) AS INTEGER) AS instances
  FROM (SELECT unnest({PART_TYPES}) AS type FROM part
        UNION ALL SELECT unnest({SUPPLIER_TYPES}) AS type FROM supplier)
  WHERE type <> '/misc/unknown'
  GROUP BY type
)"""


def filt_types(x: str) -> str:
    return (f"list_filter({x}, lambda t: NOT starts_with(t, {q(C.TYPE_DROP_PREFIX)}) "
            f"AND NOT list_contains({arr(C.TYPE_BLACKLIST)}, t))")


def arg_ok(a: str) -> str:
    return (f"(length({a}) >= {C.MIN_ARG_LENGTH} AND NOT regexp_matches({a}, '[0-9]{{3}}') "
            f"AND {a} NOT IN ({', '.join(q(w) for w in C.ARG_STOP_WORDS)}))")


def dbl(x) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def w2(shared: str, pairs: str) -> str:
    return (f"CASE WHEN {pairs} = 0 THEN CAST(0.0 AS DOUBLE) ELSE CAST(CAST(floor((200 * {shared} + {pairs}) / (2 * {pairs})) "
            f"AS BIGINT) AS DOUBLE) / CAST(100.0 AS DOUBLE) END")


def term(w: str) -> str:
    return f"CAST(pow(CAST(10.0 AS DOUBLE), CAST(4.0 AS DOUBLE) * {w}) AS DECIMAL(20,6))"


def typing_ctes(role="arg1", k=15, max_types=5, min_share=3, min_w=0.10, per_rel=150) -> list[str]:
    """``samp`` is the sample of AG6 alone; weights, entity sets and arguments come from all rows."""
    return [TYPE_DIM, f"""ent_raw AS (
  SELECT rel, {role}_fbid AS fbid, list_sort({filt_types(f'{role}_types')}) AS ftypes, row_id
  FROM tuples WHERE {role}_fbid IS NOT NULL
),
known AS (
  SELECT ftypes, list_sort(list_distinct(list(t))) AS types
  FROM (SELECT ftypes, unnest(ftypes) AS t FROM (SELECT DISTINCT ftypes FROM ent_raw WHERE len(ftypes) > 0))
  WHERE t IN (SELECT type FROM tdim)
  GROUP BY ftypes
),
ent AS (
  SELECT e.rel, e.fbid, k.types, array_to_string(k.types, ',') AS tkey,
         md5(concat_ws('|', e.rel, e.fbid, array_to_string(k.types, ','), e.row_id)) AS h
  FROM ent_raw e JOIN known k ON e.ftypes = k.ftypes
),
samp AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rel ORDER BY h, fbid, tkey) AS rn FROM ent)
  WHERE rn <= {per_rel}
),
sets AS (SELECT rel, tkey, any_value(types) AS types, count(*) AS n FROM ent GROUP BY rel, tkey),
shared AS (
  SELECT a.rel, CAST(sum(CASE WHEN a.tkey = b.tkey THEN a.n * (a.n - 1) // 2 ELSE a.n * b.n END) AS BIGINT) AS shared
  FROM sets a JOIN sets b ON a.rel = b.rel AND a.tkey <= b.tkey
  WHERE len(list_intersect(a.types, b.types)) > 0 GROUP BY a.rel
),
stats AS (
  SELECT rel, n_sample, shared, n_sample * (n_sample - 1) // 2 AS pairs,
         CASE WHEN n_sample <= 1 THEN CAST(0.0 AS DOUBLE)
              ELSE CAST(shared AS DOUBLE) / CAST(n_sample * (n_sample - 1) // 2 AS DOUBLE) END AS weight
  FROM (SELECT s.rel, CAST(sum(s.n) AS BIGINT) AS n_sample, coalesce(max(sh.shared), 0) AS shared
        FROM sets s LEFT JOIN shared sh ON s.rel = sh.rel GROUP BY s.rel)
),
stats2 AS (SELECT *, {w2('shared', 'pairs')} AS weight_2dp FROM stats),
rel_ent AS (SELECT DISTINCT rel, fbid, types, tkey FROM ent),
relinfo AS (
  SELECT s.rel, s.weight_2dp, (SELECT count(*) FROM rel_ent e WHERE e.rel = s.rel) AS n_entities
  FROM stats2 s
  WHERE length(s.rel) >= {C.MIN_REL_LENGTH} AND length(s.rel) <= {C.MAX_REL_LENGTH} AND s.n_sample > 0
    AND s.weight >= {dbl(min_w)}
),
ra AS (
  SELECT DISTINCT rel, {role} AS arg FROM tuples
  WHERE {arg_ok(role)} AND rel IN (SELECT rel FROM relinfo)
),
ar AS (SELECT a.arg, a.rel, r.weight_2dp, r.n_entities FROM ra a JOIN relinfo r ON a.rel = r.rel),
scores AS (
  SELECT ar.arg, e.fbid, e.tkey, any_value(e.types) AS types, sum({term('ar.weight_2dp')}) AS score
  FROM ar JOIN rel_ent e ON ar.rel = e.rel
  GROUP BY ar.arg, e.fbid, e.tkey
),
totals AS (SELECT arg, sum({term('weight_2dp')} * n_entities) AS total_weight FROM ar GROUP BY arg),
top AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY arg ORDER BY score DESC, fbid, tkey) AS rank FROM scores)
  WHERE rank <= {k}
),
shares AS (
  SELECT s.arg, s.type, s.share, d.enum FROM (
    SELECT arg, type, count(*) AS share FROM (SELECT arg, unnest(types) AS type FROM top) GROUP BY arg, type
  ) s JOIN tdim d ON s.type = d.type
  WHERE s.share >= {min_share}
),
ttypes AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY arg ORDER BY share DESC, enum) AS rank FROM shares)
  WHERE rank <= {max_types}
),
pred AS (
  SELECT t.arg, t.types, CAST(tt.total_weight AS DOUBLE) AS total_weight, f.top_fbids
  FROM (SELECT arg, string_agg(type || '@' || CAST(share AS VARCHAR), ', ' ORDER BY share DESC, enum) AS types
        FROM ttypes GROUP BY arg) t
  JOIN totals tt ON t.arg = tt.arg
  JOIN (SELECT arg, string_agg(fbid, ',' ORDER BY rank) AS top_fbids FROM top WHERE rank <= {C.TOP_FBIDS_IN_PREDICTION} GROUP BY arg) f
    ON t.arg = f.arg
)"""]


# ---------------------------------------------------------------------------
# linked groups, regroup, upsert
# ---------------------------------------------------------------------------

ORDER_FIRST = "concat_ws('|', inst_id, coalesce(arg1_fbid, ''), coalesce(arg2_fbid, ''))"
ENT_STRUCT = ("{'arg1_fbid': arg1_fbid, 'arg1_name': arg1_name, 'arg1_inlinks': arg1_inlinks, 'arg1_types': arg1_types, "
              "'arg2_fbid': arg2_fbid, 'arg2_name': arg2_name, 'arg2_inlinks': arg2_inlinks, 'arg2_types': arg2_types}")
ENT_COLS = ["arg1_fbid", "arg1_name", "arg1_inlinks", "arg1_types", "arg2_fbid", "arg2_name", "arg2_inlinks", "arg2_types"]


def unstruct(e: str, cols=ENT_COLS) -> str:
    return ", ".join(f"struct_extract({e}, '{c}') AS {c}" for c in cols)


LINKED = f"""parts AS (
  SELECT arg1, rel, arg2, arg_min({ENT_STRUCT}, {ORDER_FIRST}) AS e FROM ex_i GROUP BY arg1, rel, arg2
),
lg AS (
  SELECT g.*, {unstruct('p.e')} FROM grp g JOIN parts p ON g.arg1 = p.arg1 AND g.rel = p.rel AND g.arg2 = p.arg2
)"""

BATCHED = f"""exb AS (SELECT *, CASE WHEN substr(md5(url), 1, 1) < '5' THEN 0 WHEN substr(md5(url), 1, 1) < 'a' THEN 3 ELSE 12 END AS batch
  FROM ex_i),
bparts AS (
  SELECT batch, arg1, rel, arg2, arg_min({ENT_STRUCT}, {ORDER_FIRST}) AS e FROM exb GROUP BY batch, arg1, rel, arg2
),
head AS (
  SELECT arg1, rel, arg2, e FROM (
    SELECT *, row_number() OVER (PARTITION BY arg1, rel, arg2 ORDER BY
      CASE WHEN struct_extract(e, 'arg1_fbid') IS NOT NULL OR struct_extract(e, 'arg2_fbid') IS NOT NULL THEN 0 ELSE 1 END, batch) AS rn
    FROM bparts)
  WHERE rn = 1
)"""


# ---------------------------------------------------------------------------
# text (TX1, TX2, E1)
# ---------------------------------------------------------------------------

def text_ctes() -> str:
    from factweave.operators.text import CLASS_WORDS, SENT_SPLIT, TOKEN_RE, TRIPLE_RE_PLAIN, WORD_RE
    cls = " ".join(f"WHEN t IN ({', '.join(q(w) for w in CLASS_WORDS[k])}) THEN '{k}'" for k in ("D", "P", "C", "V", "R"))
    return f"""sents AS (
  SELECT doc_id, url, unnest(s) AS sentence, unnest(range(1, len(s) + 1)) AS sid FROM (
    SELECT doc_id, concat_ws('/', source, CAST(doc_id AS VARCHAR)) AS url, regexp_split_to_array(text, {q(SENT_SPLIT)}) AS s
    FROM documents)
),
toks AS (
  SELECT * FROM (SELECT *, regexp_extract_all(lower(sentence), {q(TOKEN_RE)}, 0) AS tokens FROM sents)
  WHERE len(tokens) > 0
),
tg AS (
  SELECT *, {', '.join(f"regexp_extract_all(tags, {q(TRIPLE_RE_PLAIN)}, {i}) AS g{i}" for i in range(1, 5))}
  FROM (SELECT *, array_to_string(list_transform(tokens, lambda t: CASE {cls} WHEN NOT regexp_matches(t, {q(WORD_RE)}) THEN 'O' WHEN t LIKE '%ly' THEN 'R' ELSE 'N' END), '') AS tags
        FROM toks)
),
mm AS (
  SELECT *, length(g1[k]) AS l1, length(g2[k]) AS l2, length(g3[k]) AS l3, length(g4[k]) AS l4
  FROM (SELECT doc_id, url, sid, sentence, tokens, g1, g2, g3, g4, unnest(range(1, len(g2) + 1)) AS k FROM tg)
),
tex_raw AS (
  SELECT doc_id, url, sid, sentence, tokens, 'documents' AS corpus,
         CAST(a1s AS INTEGER) AS arg1_start, CAST(l2 AS INTEGER) AS arg1_len,
         CAST(a1s + l2 AS INTEGER) AS rel_start, CAST(l3 AS INTEGER) AS rel_len,
         CAST(a1s + l2 + l3 AS INTEGER) AS arg2_start, CAST(l4 AS INTEGER) AS arg2_len
  FROM (SELECT *, coalesce(sum(l1 + l2 + l3 + l4) OVER (PARTITION BY doc_id, sid ORDER BY k
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + l1 AS a1s FROM mm)
),
tex AS (
  SELECT *,
    {norm_arg(sl('tokens', 'arg1_start', 'arg1_len'))} AS arg1,
    {norm_rel(sl('tokens', 'rel_start', 'rel_len'))} AS rel,
    {norm_arg(sl('tokens', 'arg2_start', 'arg2_len'))} AS arg2,
    {conf_sql()} AS confidence
  FROM tex_raw
),
tex_i AS (
  SELECT *, {INST_ID} AS inst_id
  FROM tex
),
tinst AS (SELECT DISTINCT arg1, rel, arg2, url, confidence, inst_id FROM tex_i)"""


def annotate_cte() -> str:
    pt = " ".join(f"WHEN t = {q(w)} THEN {q(tag)}" for w, tag in C.LEXICON.items())
    from factweave.operators.text import WORD_RE
    return f"""ann AS (
  SELECT doc_id, sid, sentence, tokens, ptags,
         list_transform(ct, lambda c, i: CASE WHEN c IS NULL THEN 'O'
              ELSE (CASE WHEN i = 1 OR ct[i - 1] IS DISTINCT FROM c THEN 'B-' ELSE 'I-' END) || c END) AS chunks
  FROM (SELECT *, list_transform(ptags, lambda g: CASE WHEN g IN ('DT', 'NN', 'NNS', 'CD', 'PRP') THEN 'NP'
                      WHEN starts_with(g, 'VB') OR g IN ('MD', 'RB') THEN 'VP'
                      WHEN g IN ('IN', 'TO') THEN 'PP' END) AS ct
        FROM (SELECT *, list_transform(tokens, lambda t: CASE {pt} WHEN NOT regexp_matches(t, {q(WORD_RE)}) THEN 'SYM'
                 WHEN regexp_matches(t, '^[0-9]+$') THEN 'CD' WHEN t LIKE '%ly' THEN 'RB' WHEN t LIKE '%ing' THEN 'VBG'
                 WHEN t LIKE '%ed' THEN 'VBD' WHEN t LIKE '%s' THEN 'NNS' ELSE 'NN' END) AS ptags FROM toks))
)"""


# ---------------------------------------------------------------------------
# linking (TX6, JN5-JN7, AG12, TX7)
# ---------------------------------------------------------------------------

LINK_TABLES = f"""pcnt AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey),
scnt AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey),
anchors AS (
  SELECT lower(p_name) AS anchor, 'm.' || CAST(p_partkey AS VARCHAR) AS fbid, coalesce(n, 0) AS link_count
  FROM part LEFT JOIN pcnt ON p_partkey = l_partkey
  UNION ALL
  SELECT lower(s_name), 's.' || CAST(s_suppkey AS VARCHAR), coalesce(n, 0)
  FROM supplier LEFT JOIN scnt ON s_suppkey = l_suppkey
),
ents AS (
  SELECT 'm.' || CAST(p_partkey AS VARCHAR) AS fbid, p_name || ' ' || p_brand AS name, coalesce(n, 0) AS inlinks,
         {PART_TYPES} AS types, CASE WHEN p_partkey % 23 <> 0 THEN [lower(p_brand)] END AS context
  FROM part LEFT JOIN pcnt ON p_partkey = l_partkey WHERE p_partkey % 19 <> 0
  UNION ALL
  SELECT 's.' || CAST(s_suppkey AS VARCHAR), s_name, coalesce(n, 0), {SUPPLIER_TYPES}, CASE WHEN s_suppkey % 7 <> 0 THEN [lower(n_name)] END
  FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN scnt ON s_suppkey = l_suppkey
),
amax AS (SELECT max(len(string_split(anchor, ' '))) AS L FROM anchors)"""

FIRST_INST = """gfirst AS (
  SELECT arg1, rel, arg2,
         arg_min({'tokens': tokens, 'arg1_start': arg1_start, 'arg1_len': arg1_len, 'rel_start': rel_start,
                  'rel_len': rel_len, 'arg2_start': arg2_start, 'arg2_len': arg2_len}, inst_id) AS f
  FROM inst GROUP BY arg1, rel, arg2
),
gsrc AS (
  SELECT arg1, rel, arg2, list_distinct(flatten(list(list_transform(tokens, lambda w: lower(w))))) AS src_tokens
  FROM inst GROUP BY arg1, rel, arg2
),
roles AS (
  SELECT g.arg1, g.rel, g.arg2, r.role,
         array_to_string(CASE WHEN r.role = 'arg1' THEN list_slice(g.f.tokens, g.f.arg1_start + 1, g.f.arg1_start + g.f.arg1_len)
                               ELSE list_slice(g.f.tokens, g.f.arg2_start + 1, g.f.arg2_start + g.f.arg2_len) END, ' ') AS arg_text
  FROM gfirst g CROSS JOIN (VALUES ('arg1'), ('arg2')) r(role)
),
targs AS (SELECT DISTINCT arg_text, string_split(lower(arg_text), ' ') AS t FROM roles),
subs AS (
  SELECT arg_text, ln, i, array_to_string(list_slice(t, i, i + ln - 1), ' ') AS phrase
  FROM (SELECT arg_text, t, ln, unnest(range(1, len(t) - ln + 2)) AS i
        FROM (SELECT arg_text, t, unnest(range(1, least(len(t), (SELECT L FROM amax)) + 1)) AS ln FROM targs))
),
heads AS (
  SELECT a.arg_text, coalesce(b.head, lower(a.arg_text)) AS head
  FROM (SELECT DISTINCT arg_text FROM targs) a
  LEFT JOIN (SELECT arg_text, arg_max(phrase, {'ln': ln, 'ni': -i}) AS head
             FROM subs WHERE phrase IN (SELECT anchor FROM anchors) GROUP BY arg_text) b ON a.arg_text = b.arg_text
)"""

def link_best(min_length: int = 0) -> str:
    """Best entity per group and role; heads shorter than ``min_length`` are not linked (PF13)."""
    return LINK_BEST_ALL.replace("WHERE_HEAD", f"WHERE length(h.head) >= {min_length}")


LINK_BEST_ALL = """q AS (
  SELECT r.arg1, r.rel, r.arg2, r.role, h.head, s.src_tokens
  FROM roles r JOIN heads h ON r.arg_text = h.arg_text
  JOIN gsrc s ON r.arg1 = s.arg1 AND r.rel = s.rel AND r.arg2 = s.arg2 WHERE_HEAD
),
best AS (
  SELECT arg1, rel, arg2, role,
         arg_min({'fbid': fbid, 'name': name, 'inlinks': inlinks, 'types': types, 'score': score},
                 {'ns': -score, 'fbid': fbid}) AS b
  FROM (SELECT q.arg1, q.rel, q.arg2, q.role, e.fbid, e.name, e.inlinks, e.types,
               a.link_count * (1 + coalesce(len(list_intersect(e.context, q.src_tokens)), 0)) AS score
        FROM q JOIN anchors a ON q.head = a.anchor JOIN ents e ON a.fbid = e.fbid)
  GROUP BY arg1, rel, arg2, role
),
linked AS (
  SELECT g.arg1, g.rel, g.arg2,
         struct_extract(b1.b, 'fbid') AS arg1_fbid, struct_extract(b1.b, 'score') AS arg1_score,
         struct_extract(b2.b, 'fbid') AS arg2_fbid, struct_extract(b2.b, 'score') AS arg2_score,
         struct_extract(b1.b, 'name') AS arg1_name, struct_extract(b2.b, 'name') AS arg2_name
  FROM gfirst g
  LEFT JOIN best b1 ON g.arg1 = b1.arg1 AND g.rel = b1.rel AND g.arg2 = b1.arg2 AND b1.role = 'arg1'
  LEFT JOIN best b2 ON g.arg1 = b2.arg1 AND g.rel = b2.rel AND g.arg2 = b2.arg2 AND b2.role = 'arg2'
)"""


LINK_BEST = link_best()


# ---------------------------------------------------------------------------
# record formats (SRC3, SRC4, SRC6-SRC8)
# ---------------------------------------------------------------------------

def record_ctes() -> str:
    from factweave.sources.records import RECORD_FIELDS
    span = lambda lst, p: f"array_to_string({sl(lst, 't.' + p + '_start', 't.' + p + '_len')}, ' ')"
    fields = ", ".join(f"CAST({c} AS VARCHAR)" for c in RECORD_FIELDS)
    return f"""rec AS (
  SELECT t.url AS docname, 'relphrase' AS extractorType, t.arg1_start AS sentenceid, t.rel_start AS eid, t.url,
         md5(replace(t.sentence, chr(9), ' ')) AS hashes, t.confidence,
         {span('t.tokens', 'arg1')} AS arg1, {span('t.tokens', 'rel')} AS rel, {span('t.tokens', 'arg2')} AS arg2,
         t.arg1 AS norm1Arg1, t.rel AS norm1Rel, t.arg2 AS norm1Arg2,
         {span('t.tokens', 'arg1')} AS norm2Arg1, {span('t.tokens', 'rel')} AS norm2Rel, {span('t.tokens', 'arg2')} AS norm2Arg2,
         {span('a.ptags', 'arg1')} AS norm1Arg1PosTags, {span('a.ptags', 'rel')} AS norm1RelPosTags,
         {span('a.ptags', 'arg2')} AS norm1Arg2PosTags,
         {span('a.ptags', 'arg1')} AS norm2Arg1PosTags, {span('a.ptags', 'rel')} AS norm2RelPosTags,
         {span('a.ptags', 'arg2')} AS norm2Arg2PosTags,
         'ARG1' AS arg1Tag, 'REL' AS relTag, 'ARG2' AS arg2Tag,
         concat_ws(chr(9), replace(t.sentence, chr(9), ' '), array_to_string(t.tokens, ' '),
                   array_to_string(a.ptags, ' '), array_to_string(a.chunks, ' ')) AS dataString
  FROM tex t JOIN ann a ON t.doc_id = a.doc_id AND t.sid = a.sid
),
rec_lines AS (
  SELECT docname, CASE WHEN eid % 7 = 0 THEN array_to_string(list_slice(string_split(v, chr(9)), 1, 20), chr(9)) ELSE v END AS value
  FROM (SELECT docname, eid, concat_ws(chr(9), {fields}) AS v FROM rec)
),
rec_parsed AS (
  SELECT * FROM (
    SELECT {', '.join(
        (f"TRY_CAST(p[{i + 1}] AS INTEGER) AS {c}" if c in ('sentenceid', 'eid') else
         f"TRY_CAST(p[{i + 1}] AS DOUBLE) AS {c}" if c == 'confidence' else f"p[{i + 1}] AS {c}")
        for i, c in enumerate(RECORD_FIELDS[:-1]))},
           array_to_string(list_slice(p, 26, len(p)), chr(9)) AS dataString
    FROM (SELECT string_split(value, chr(9)) AS p FROM rec_lines) WHERE len(p) >= 26)
  WHERE sentenceid IS NOT NULL AND eid IS NOT NULL AND confidence IS NOT NULL
)"""
