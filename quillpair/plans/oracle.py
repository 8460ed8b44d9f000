"""DuckDB SQL twins of the registered queries (the driver's correctness oracle).

Written independently of the Spark plans (windows and unnest where Spark
uses higher-order functions, and so on); only the regex constants and
fixed word lists are shared.
"""

from __future__ import annotations

from .. import resources as R
from . import sqltext as Q
from ..functions import text as T
from ..operators import sentences as SE

ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLE[name] = sql


LC_TEXT = Q.lower_collapse("text")

# ---------------------------------------------------------------- profile (M0, M2)

oracle("top_words", "SELECT * FROM " + Q.top_terms(
    "SELECT doc_id, text FROM documents", "doc_id", Q.alpha_words(LC_TEXT), "word",
    exclude=Q.stop_words_list()))

oracle("top_question_words", "SELECT * FROM " + Q.top_terms(
    "SELECT doc_id, text FROM documents", "doc_id", Q.question_words(LC_TEXT), "word"))

oracle("top_phrases", " UNION ALL ".join(
    f"SELECT '{a}' AS anchor, * FROM " + Q.top_terms(
        "SELECT doc_id, text FROM documents", "doc_id", Q.anchored_phrases(LC_TEXT, a), "phrase")
    for a in ("what", "the")))

oracle("top_phrases_joined", "SELECT * FROM " + Q.top_terms(
    f"SELECT 0 AS z, string_agg(t, ' ' ORDER BY doc_id) AS text FROM (SELECT doc_id, {LC_TEXT} AS t FROM documents)",
    "z", Q.anchored_phrases("text", "the"), "phrase"))

oracle("profile_shape", """
SELECT count(*) AS n_rows, CAST((SELECT count(*) FROM (DESCRIBE documents)) AS BIGINT) AS n_cols
FROM documents""")

_DOC_COLS = ["doc_id", "text", "lang", "source", "n_chars"]
_DOC_TYPES = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string",
              "n_chars": "bigint"}

oracle("profile_info", " UNION ALL ".join(
    f"SELECT CAST({i + 1} AS BIGINT) AS ordinal, '{c}' AS column, "
    f"CASE typeof({c}) WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' "
    f"WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' ELSE lower(typeof({c})) END AS dtype, "
    f"count({c}) AS non_null FROM documents GROUP BY typeof({c})"
    for i, c in enumerate(_DOC_COLS)))

oracle("profile_nulls", " UNION ALL ".join(
    f"SELECT CAST({i + 1} AS BIGINT) AS ordinal, '{c}' AS column, "
    f"CAST(count(*) - count({c}) AS BIGINT) AS n_null FROM documents"
    for i, c in enumerate(_DOC_COLS)))

oracle("describe_text", " UNION ALL ".join(f"""
SELECT '{c}' AS column, CAST(sum(freq) AS BIGINT) AS count, count(*) AS unique,
       arg_max(v, (freq, -first_row)) AS top, max(freq) AS freq
FROM (SELECT {c} AS v, count(*) AS freq, min(doc_id) AS first_row
      FROM documents WHERE {c} IS NOT NULL GROUP BY {c})""" for c in ("text", "lang", "source")))

oracle("describe_numeric", " UNION ALL ".join(f"""
SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS std, round(min({c})::DOUBLE, 6) AS min,
       round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
       round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c})::DOUBLE, 6) AS max
FROM documents""" for c in ("doc_id", "n_chars")))

oracle("context_length_hist", f"""
SELECT {Q.word_count('text')} AS n_words, count(*) AS n_texts
FROM documents WHERE text IS NOT NULL GROUP BY 1""")

oracle("question_length_hist", f"""
SELECT {Q.word_count('text')} AS n_words, count(*) AS n_texts
FROM conversations WHERE role = 'user' AND text IS NOT NULL GROUP BY 1""")

# ---------------------------------------------------------------- cleaning (M1)

oracle("clean_pages", f"SELECT page_id, {Q.normalise_text('html')} AS clean FROM pages")

oracle("expand_contractions", f"""
SELECT doc_id, {Q.expand_contractions(
    "replace(replace(replace(text, ' the ', ' it''s '), ' and ', ' Don''t '), ' ''', '''')")}
    AS expanded FROM documents""")

_NA = ", ".join(Q.q(t) for t in R.NA_TOKENS)

oracle("na_and_dedup", f"""
WITH t AS (SELECT doc_id AS row_id,
                  CASE WHEN text IN ({_NA}) THEN NULL ELSE text END AS context,
                  CASE WHEN lang IN ({_NA}) THEN NULL ELSE lang END AS question
           FROM documents)
SELECT min(row_id) AS row_id, context, question FROM t
WHERE context IS NOT NULL AND question IS NOT NULL GROUP BY context, question""")

PAIRS_SQL = """
SELECT CAST(q.conv_id AS VARCHAR) || ':' || CAST(q.turn AS VARCHAR) AS pair_id, q.text AS question, a.text AS context
FROM conversations q JOIN conversations a
  ON a.conv_id = q.conv_id AND a.turn = q.turn + 1
WHERE q.role = 'user' AND a.role = 'assistant'"""

oracle("clean_pairs", f"""
WITH t AS (SELECT pair_id AS row_id,
                  CASE WHEN context IN ({_NA}) THEN NULL ELSE context END AS context,
                  CASE WHEN question IN ({_NA}) THEN NULL ELSE question END AS question
           FROM ({PAIRS_SQL})),
d AS (SELECT min(row_id) AS row_id, context, question FROM t
      WHERE context IS NOT NULL AND question IS NOT NULL GROUP BY context, question)
SELECT row_id, {Q.normalise_text('context')} AS context, {Q.normalise_text('question')} AS question
FROM d""")

# ---------------------------------------------------------------- generation, ensemble (M6)


def _with(ctes: list[tuple[str, str]], final: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in ctes) + "\n" + final


_FIRST_TOKS = f"coalesce({Q.ws_tokens(Q.sentences('context') + '[1]')}, []::VARCHAR[])"


def _as_question(toks: str) -> str:
    body = f"regexp_replace(array_to_string({toks}, ' '), '[.!?]+$', '')"
    return f"CASE WHEN {body} = '' THEN '' ELSE {body} || '?' END"


_CLOZE_TOKS = ("list_transform(toks, lambda x, i: CASE WHEN i = "
               "list_position(list_transform(toks, lambda y: length(y)), "
               "list_max(list_transform(toks, lambda y: length(y)))) THEN 'what' ELSE x END)")


def _sentence_ctes(src: str, key: str, text: str, name: str = "") -> list[tuple[str, str]]:
    """Sentences of a text with their token lists: (key, pos, toks)."""
    return [
        (f"ss{name}", f"SELECT {key}, {Q.sentences(text)} AS sl FROM {src}"),
        (f"se{name}", f"SELECT {key}, unnest(sl) AS s, unnest(range(1, len(sl) + 1)) AS pos FROM ss{name}"),
        (f"st{name}", f"SELECT {key}, pos, {Q.ws_tokens('s')} AS toks FROM se{name}"),
    ]


#: Every distinct question of both generators, ranked by its first sentence.
GEN_CTES = [("p", PAIRS_SQL)] + _sentence_ctes("p", "pair_id", "context") + [
    ("qe", f"SELECT pair_id, pos, 'lead' AS variant, {_as_question('toks')} AS generated FROM st UNION ALL "
           f"SELECT pair_id, pos, 'cloze' AS variant, {_as_question(_CLOZE_TOKS)} AS generated FROM st"),
    ("qf", "SELECT pair_id, variant, generated, min(pos) AS first_pos FROM qe GROUP BY pair_id, variant, generated"),
    ("cands", "SELECT pair_id, variant, generated, row_number() OVER "
              "(PARTITION BY pair_id, variant ORDER BY first_pos) AS rank FROM qf"),
]

_SPECIALS = " UNION ALL ".join(f"SELECT {Q.q(t)} AS token, {i} AS id"
                               for i, t in enumerate(R.SPECIAL_TOKENS))


def _vocab_ctes(table: str, name: str) -> list[tuple[str, str]]:
    return [
        (f"{name}_t", f"SELECT unnest({Q.ws_tokens('text')}) AS token FROM {table}"),
        (f"{name}_c", f"SELECT token, count(*) AS n FROM {name}_t WHERE token NOT IN "
                      f"({', '.join(Q.q(t) for t in R.SPECIAL_TOKENS)}) GROUP BY token"),
        (f"{name}_0", f"SELECT token, row_number() OVER (ORDER BY n DESC, token) + {len(R.SPECIAL_TOKENS) - 1} AS id "
                      f"FROM {name}_c UNION ALL SELECT token, id FROM ({_SPECIALS})"),
        (name, f"SELECT token, id FROM {name}_0 UNION ALL SELECT {Q.q(R.SEP_TOKEN)}, "
               f"(SELECT max(id) + 1 FROM {name}_0) WHERE NOT EXISTS "
               f"(SELECT 1 FROM {name}_0 WHERE token = {Q.q(R.SEP_TOKEN)})"),
    ]


VOCAB_CTES = _vocab_ctes("documents", "vocab")
VV_CTES = VOCAB_CTES + _vocab_ctes("conversations", "vocab_conv") + [
    ("vv", "SELECT 'lead' AS variant, token FROM vocab UNION ALL SELECT 'cloze', token FROM vocab_conv")]


def _rated_ctes(cands: str, key: str) -> list[tuple[str, str]]:
    """Rare words per candidate, and the best candidate per (key, rank)."""
    best = "(rare_words, length(generated), CASE variant WHEN 'lead' THEN 0 ELSE 1 END)"
    return [
        ("cw", f"SELECT {key}, rank, variant, unnest({Q.ws_tokens('generated')}) AS token FROM {cands}"),
        ("rc", f"SELECT {key}, rank, variant, count(*) AS rare FROM cw ANTI JOIN vv USING (variant, token) "
               f"GROUP BY {key}, rank, variant"),
        ("rated", f"SELECT c.{key}, c.rank, c.variant, c.generated, coalesce(rc.rare, 0) AS rare_words "
                  f"FROM {cands} c LEFT JOIN rc USING ({key}, rank, variant)"),
        ("ens", f"SELECT {key}, rank, 'combined' AS variant, arg_min(generated, {best}) AS generated, "
                f"arg_min(variant, {best}) AS chosen FROM rated GROUP BY {key}, rank"),
    ]


RATED_CTES = GEN_CTES + VV_CTES + _rated_ctes("cands", "pair_id")

oracle("pairs", PAIRS_SQL)
oracle("generate_lead", _with([("p", PAIRS_SQL), ("ft", f"SELECT pair_id, {_FIRST_TOKS} AS toks FROM p")],
                              f"SELECT pair_id, 'lead' AS variant, {_as_question('toks')} AS generated FROM ft"))
oracle("generate_cloze", _with(GEN_CTES, "SELECT * FROM cands WHERE variant = 'cloze'"))


def _chain_ctes(name: str, table: str, keys: str, text: str) -> list[tuple[str, str]]:
    """Adjacent words (a, b) of every sentence between the marks."""
    words = Q.ws_tokens("lower(regexp_replace(s, '[.!?]+$', ''))")
    return [(f"{name}s", f"SELECT {keys}unnest({Q.sentences(text)}) AS s FROM {table}"),
            (f"{name}w", f"SELECT {keys}{words} AS w FROM {name}s"),
            (f"{name}c", f"SELECT {keys}['<s>'] || w || ['</s>'] AS w FROM {name}w WHERE len(w) > 0"),
            (name, f"SELECT {keys}w[i] AS a, w[i + 1] AS b FROM "
                   f"(SELECT {keys}w, unnest(range(1, len(w))) AS i FROM {name}c)")]


#: Smoothed transitions of each context in micro units.
LP_CTES = [("p", PAIRS_SQL)] + _chain_ctes("qc", "p", "", "question") + _chain_ctes("cc", "p", "pair_id, ", "context") + [
    ("qn", "SELECT a, b, count(*) AS n FROM qc GROUP BY a, b"),
    ("qa", "SELECT a, count(*) AS n_a FROM qc GROUP BY a"),
    ("own", "SELECT *, sum(c) OVER (PARTITION BY pair_id, a) AS t FROM "
            "(SELECT pair_id, a, b, count(*) AS c FROM cc GROUP BY pair_id, a, b)"),
    ("lps", "SELECT pair_id, a, b, CAST(round(1000000 * ln((coalesce(n, 0) + c / t) / (coalesce(n_a, 0) + 1.0))) AS BIGINT) "
            "AS lp FROM own LEFT JOIN qn USING (a, b) LEFT JOIN qa USING (a)"),
]


def _beam(beams: int, penalty: float, n: int, steps: int = 256) -> str:
    """Beam search as a recursive query: a step is one join, the ended continuations among the first ``beams`` are
    results and the best others go on until ``beams`` have ended."""
    score = f"round(s / 1000000.0 / pow(len(w) + 1, {penalty}), 9)"
    return "WITH RECURSIVE " + ", ".join(f"{k} AS ({v})" for k, v in LP_CTES) + f""", beam AS (
        SELECT DISTINCT pair_id, 0 AS step, CAST(0 AS BIGINT) AS s, ['<s>'] AS w, [''] AS grams, false AS ended,
               CAST(0 AS BIGINT) AS n_ended FROM cc
        UNION ALL
        SELECT pair_id, step, s, w, grams, ended, n_ended FROM (
            SELECT *, row_number() OVER (PARTITION BY pair_id, ended ORDER BY s DESC, w) AS of_kind,
                   n_before + count(*) FILTER (WHERE ended AND place <= {beams}) OVER (PARTITION BY pair_id) AS n_ended
            FROM (
                SELECT beam.pair_id, beam.step + 1 AS step, beam.s + lp AS s, beam.w || [b] AS w,
                       beam.grams || [a || ' ' || b] AS grams, b = '</s>' AS ended, beam.n_ended AS n_before,
                       row_number() OVER (PARTITION BY beam.pair_id ORDER BY beam.s + lp DESC, beam.w || [b]) AS place
                FROM beam JOIN lps ON lps.pair_id = beam.pair_id AND lps.a = beam.w[-1]
                WHERE NOT beam.ended AND beam.n_ended < {beams} AND beam.step < {steps}
                      AND NOT list_contains(beam.grams, a || ' ' || b))
            WHERE place <= {2 * beams})
        WHERE CASE WHEN ended THEN place <= {beams} ELSE of_kind <= {beams} END),
    fin AS (
        SELECT pair_id, s, w[2:-2] AS w FROM beam WHERE ended
        UNION ALL SELECT pair_id, s, w[2:] FROM beam WHERE NOT ended AND step = {steps} AND n_ended < {beams}),
    ranked AS (SELECT pair_id, array_to_string(w, ' ') || '?' AS generated, {score} AS score,
                      row_number() OVER (PARTITION BY pair_id ORDER BY {score} DESC, w) AS rank FROM fin)
    SELECT pair_id, rank, generated, score FROM ranked WHERE rank <= {n}"""


oracle("generate_beam", _beam(10, 1.5, 1))
oracle("generate_nbest", _beam(10, 1.0, 5))
_FIRST_LAST = Q.ws_tokens("regexp_replace(prompt, ' </s>$', '')")
oracle("generate_plugin", f"""
SELECT pair_id, variant, CASE WHEN len(w) > 0 THEN w[1] || ' ' || w[-1] || '?' ELSE '' END AS generated
FROM (SELECT pair_id, variant, {_FIRST_LAST} AS w FROM
      (SELECT pair_id, variant, prefix || context || ' </s>' AS prompt FROM ({PAIRS_SQL}),
       (VALUES ('BART', ''), ('T5', '{R.T5_PREFIX}')) AS c(variant, prefix)))""")
oracle("vocab", _with(VOCAB_CTES, "SELECT * FROM vocab"))
oracle("rare_words", _with(RATED_CTES, "SELECT * FROM rated"))
oracle("ensemble_select", _with(RATED_CTES, "SELECT * FROM ens"))
oracle("ensemble_ranked", _with(RATED_CTES, "SELECT * FROM ens WHERE rank <= 5"))

_SENTS = f"list_transform({Q.sentences('text')}, lambda s: array_to_string({Q.ws_tokens('s')}, ' '))"
oracle("n_distinct_candidates", _with([
    ("s", f"SELECT doc_id, unnest({_SENTS}) AS candidate, "
          f"unnest(range(1, len({_SENTS}) + 1)) AS pos FROM documents"),
    ("f", "SELECT doc_id, candidate, min(pos) AS first_pos FROM s GROUP BY doc_id, candidate"),
    ("r", "SELECT doc_id, candidate, row_number() OVER (PARTITION BY doc_id ORDER BY first_pos) "
          "AS rank FROM f"),
], "SELECT doc_id, CAST(rank AS BIGINT) AS rank, candidate FROM r WHERE rank <= 5"))

# ---------------------------------------------------------------- metrics (M4)


def _lcs(h: str, r: str) -> str:
    """LCS length by the row DP: cur[j] = max(prev[j], max over k<=j of
    (r[k] = t ? prev[k-1] + 1 : 0))."""
    step = (f"lambda prev, t: list_transform(range(0, len({r}) + 1), lambda j: CASE WHEN j = 0 "
            f"THEN 0 ELSE greatest(prev[j + 1], list_max(list_transform(range(1, j + 1), "
            f"lambda k: CASE WHEN {r}[k] = t THEN prev[k] + 1 ELSE 0 END))) END)")
    init = f"list_transform(range(0, len({r}) + 1), lambda j: 0)"
    return f"list_reduce({h}, {step}, {init})[len({r}) + 1]"


_ROW = "pair_id, rank, variant"


def _meteor_stage(name: str, left: str, by: str) -> list[tuple[str, str]]:
    """Pairs of the k-th last equal values of both sides among rows (row, side, pos, t, by)."""
    return [
        (f"{name}k", f"SELECT *, row_number() OVER (PARTITION BY {_ROW}, side, {by} ORDER BY pos DESC) AS k FROM {left}"),
        (f"{name}m", f"SELECT {_ROW}, a.pos AS i, b.pos AS j FROM (SELECT * FROM {name}k WHERE side = 'h') a "
                     f"JOIN (SELECT * FROM {name}k WHERE side = 'r') b USING ({_ROW}, {by}, k)"),
        (f"{name}l", f"SELECT {_ROW}, side, pos, t FROM {left} WHERE side = 'h' AND ({_ROW}, pos) NOT IN "
                     f"(SELECT ({_ROW}, i) FROM {name}m) UNION ALL SELECT {_ROW}, side, pos, t FROM {left} "
                     f"WHERE side = 'r' AND ({_ROW}, pos) NOT IN (SELECT ({_ROW}, j) FROM {name}m)"),
    ]


def _synonym_walk() -> list[tuple[str, str]]:
    """Several sets per word: the walk from the end as a recursive query, a hypothesis word a step."""
    bare = "regexp_replace(stem, '[^a-z]', '', 'g')"
    return [
        ("syn", f"SELECT DISTINCT stem, unnest(['a:' || left({bare}, 3), 'b:' || right({bare}, 3)]) AS set_id "
                f"FROM cstems WHERE length({bare}) >= 3"),
        ("z0", "SELECT yl.*, syn.set_id FROM yl JOIN stems USING (t) JOIN syn USING (stem)"),
        ("ze", f"SELECT DISTINCT {_ROW}, a.pos AS i, b.pos AS j FROM (SELECT * FROM z0 WHERE side = 'h') a "
               f"JOIN (SELECT * FROM z0 WHERE side = 'r') b USING ({_ROW}, set_id)"),
        ("zc", f"SELECT {_ROW}, i, list(j ORDER BY j DESC) AS js, row_number() OVER (PARTITION BY {_ROW} ORDER BY i DESC) AS k "
               f"FROM ze GROUP BY {_ROW}, i"),
        ("zw", f"""SELECT DISTINCT {_ROW}, CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS i, CAST(NULL AS BIGINT) AS j,
                          []::BIGINT[] AS used FROM zc
                   UNION ALL
                   SELECT {_ROW}, k, i, j, CASE WHEN j IS NULL THEN used ELSE list_append(used, j) END FROM
                   (SELECT {_ROW}, zc.k, zc.i, list_filter(zc.js, lambda x: NOT list_contains(zw.used, x))[1] AS j, zw.used
                    FROM zw JOIN zc USING ({_ROW}) WHERE zc.k = zw.k + 1)"""),
        ("zm", f"SELECT {_ROW}, i, j FROM zw WHERE j IS NOT NULL"),
    ]


def _metric_ctes(cands: str, stems: bool = True, synonyms: bool | str = False) -> list[tuple[str, str]]:
    """Per (pair_id, rank, variant): rouge_p/r/f, matches/chunks/meteor, bleu1..4."""
    tb_h, tb_r = Q.treebank_tokens("generated"), Q.treebank_tokens("question")
    ctes = [
        ("sc", f"SELECT {_ROW}, c.generated, p.question FROM {cands} c JOIN p USING (pair_id)"),
        ("tk", f"SELECT {_ROW}, {Q.rouge_tokens('generated')} AS hr, "
               f"{Q.rouge_tokens('question')} AS rr, {tb_h} AS ht, {tb_r} AS rt, "
               f"{Q.ws_tokens('lower(generated)')} AS hw, {Q.ws_tokens('lower(question)')} AS rw "
               f"FROM sc"),
        # ROUGE-L
        ("rl", f"SELECT {_ROW}, len(hr) AS nh, len(rr) AS nr, {_lcs('hr', 'rr')} AS lcs FROM tk"),
        ("rouge", f"SELECT {_ROW}, CASE WHEN nh > 0 THEN lcs / nh ELSE 0.0 END AS rouge_p, "
                  "CASE WHEN nr > 0 THEN lcs / nr ELSE 0.0 END AS rouge_r FROM rl"),
        ("rouge2", "SELECT *, CASE WHEN rouge_p + rouge_r > 0 THEN 2 * rouge_p * rouge_r / "
                   "(rouge_p + rouge_r) ELSE 0.0 END AS rouge_f FROM rouge"),
        # METEOR: stages by rank from the end, chunks by lag
        ("m0", f"SELECT {_ROW}, 'h' AS side, unnest(hw) AS t, unnest(range(1, len(hw) + 1)) AS pos FROM tk UNION ALL "
               f"SELECT {_ROW}, 'r', unnest(rw), unnest(range(1, len(rw) + 1)) FROM tk"),
    ] + _meteor_stage("x", "m0", "t")
    found = ["xm"]
    if stems:
        ctes += Q.stem_ctes("stems", "SELECT DISTINCT t FROM xl")
        ctes += [("y0", "SELECT xl.*, stems.stem FROM xl JOIN stems USING (t)")] + _meteor_stage("y", "y0", "stem")
        found.append("ym")
    if synonyms:
        ctes += Q.stem_ctes("cstems", f"SELECT DISTINCT unnest({Q.ws_tokens('lower(text)')}) AS t FROM conversations")
    if synonyms == "sets":
        ctes += _synonym_walk()
        found.append("zm")
    elif synonyms:
        ctes += [("syn", "SELECT stem, min(regexp_replace(stem, '[^a-z]', '', 'g')) AS set_id FROM cstems "
                         "WHERE regexp_replace(stem, '[^a-z]', '', 'g') <> '' GROUP BY stem"),
                 ("z0", "SELECT yl.*, syn.set_id FROM yl JOIN stems USING (t) JOIN syn USING (stem)")]
        ctes += _meteor_stage("z", "z0", "set_id")
        found.append("zm")
    ctes += [
        ("mm", " UNION ALL ".join(f"SELECT * FROM {f}" for f in found)),
        ("ml", f"SELECT *, lag(i) OVER w AS pi, lag(j) OVER w AS pj FROM mm WINDOW w AS (PARTITION BY {_ROW} ORDER BY i)"),
        ("mc", f"SELECT {_ROW}, count(*) AS matches, "
               "sum(CASE WHEN pi IS NOT NULL AND i = pi + 1 AND j = pj + 1 THEN 0 ELSE 1 END) "
               f"AS chunks FROM ml GROUP BY {_ROW}"),
        ("met", f"SELECT {_ROW}, coalesce(mc.matches, 0) AS matches, coalesce(mc.chunks, 0) AS chunks, "
                f"len(t.hw) AS nh, len(t.rw) AS nr FROM tk t LEFT JOIN mc USING ({_ROW})"),
        ("met2", f"SELECT {_ROW}, CAST(matches AS BIGINT) AS matches, "
                 f"CAST(chunks AS BIGINT) AS chunks, CASE WHEN matches = 0 THEN 0.0 ELSE "
                 f"(1 - {R.METEOR_GAMMA} * pow(chunks / matches, {R.METEOR_BETA})) * "
                 f"((matches / nh) * (matches / nr) / ({R.METEOR_ALPHA} * (matches / nh) + "
                 f"{1 - R.METEOR_ALPHA} * (matches / nr))) END AS meteor FROM met"),
        # BLEU: n-gram counts on both sides, clipped by a left join
        ("orders", "SELECT unnest(range(1, 5)) AS n"),
        ("bh", f"SELECT {_ROW}, n, unnest(list_transform(range(1, len(ht) - n + 2), "
               "lambda i: array_to_string(ht[i:i + n - 1], ' '))) AS g FROM tk, orders"),
        ("br", f"SELECT {_ROW}, n, unnest(list_transform(range(1, len(rt) - n + 2), "
               "lambda i: array_to_string(rt[i:i + n - 1], ' '))) AS g FROM tk, orders"),
        ("bhc", f"SELECT {_ROW}, n, g, count(*) AS c FROM bh GROUP BY ALL"),
        ("brc", f"SELECT {_ROW}, n, g, count(*) AS c FROM br GROUP BY ALL"),
        ("bclip", f"SELECT {_ROW}, n, sum(least(a.c, coalesce(b.c, 0))) AS num "
                  f"FROM bhc a LEFT JOIN brc b USING ({_ROW}, n, g) GROUP BY ALL"),
        ("bn", f"SELECT {_ROW}, len(t.ht)::DOUBLE AS nh, len(t.rt)::DOUBLE AS nr, "
               + ", ".join(f"coalesce(sum(CASE WHEN c.n = {n} THEN c.num END), 0) AS num{n}"
                           for n in range(1, 5))
               + f" FROM tk t LEFT JOIN bclip c USING ({_ROW}) GROUP BY ALL"),
    ]
    z = {n: f"(CASE WHEN num{n} = 0 AND nh > 1 THEN 1 ELSE 0 END)" for n in range(1, 5)}
    ps = []
    for n in range(1, 5):
        k = " + ".join(["1"] + [z[j] for j in range(1, n)])
        den = f"greatest(nh - {n} + 1, 1.0)"
        ps.append(f"CASE WHEN num{n} > 0 THEN num{n} / {den} WHEN nh > 1 THEN "
                  f"(ln(nh) / (pow(2.0, {k}) * {R.BLEU_METHOD4_K})) / {den} ELSE 0.0 END AS p{n}")
    ctes.append(("bp", "SELECT *, " + ", ".join(ps) + ", CASE WHEN nh > nr THEN 1.0 WHEN nh = 0 "
                       "THEN 0.0 ELSE exp(1 - nr / nh) END AS bpen FROM bn"))
    bl = []
    for big in range(1, 5):
        s = " + ".join(f"CASE WHEN p{i} > 0 THEN ln(p{i}) / {big} ELSE 0.0 END" for i in range(1, big + 1))
        bl.append(f"CASE WHEN num1 = 0 THEN 0.0 ELSE bpen * exp({s}) END AS bleu{big}")
    ctes.append(("bleu", f"SELECT {_ROW}, " + ", ".join(bl) + " FROM bp"))
    ctes.append(("scored", f"SELECT {_ROW}, rouge_p, rouge_r, rouge_f, matches, chunks, meteor, bleu1, bleu2, bleu3, "
                           f"bleu4 FROM rouge2 JOIN met2 USING ({_ROW}) JOIN bleu USING ({_ROW})"))
    return ctes


METRIC_CTES = GEN_CTES + _metric_ctes("cands")
_METEOR = f"SELECT {_ROW}, matches, chunks, round(meteor, 6) AS meteor FROM scored"

oracle("rouge_l", _with(METRIC_CTES, f"SELECT {_ROW}, round(rouge_p, 6) AS precision, "
                                     "round(rouge_r, 6) AS recall, round(rouge_f, 6) AS fmeasure "
                                     "FROM scored"))
oracle("bleu", _with(METRIC_CTES, f"SELECT {_ROW}, " + ", ".join(
    f"round(bleu{n}, 6) AS bleu{n}" for n in range(1, 5)) + " FROM scored"))
oracle("meteor_exact", _with(GEN_CTES + _metric_ctes("cands", stems=False), _METEOR))
oracle("meteor_stem", _with(METRIC_CTES, _METEOR))
oracle("meteor_synonym", _with(GEN_CTES + _metric_ctes("cands", synonyms=True), _METEOR))
oracle("meteor_synonym_sets", _with(GEN_CTES + _metric_ctes("cands", synonyms="sets"), _METEOR)
       .replace("WITH ", "WITH RECURSIVE ", 1))


def _abbreviated(e: str) -> str:
    for words, new in (("by|de", "cf."), ("with|la", "Dr. Anea"), ("is|der", "e.g."), ("was|que", "J. Thor"),
                       ("on|et", "No. 7.")):
        e = f"regexp_replace({e}, ' ({words}) ', ' {new} ', 'g')"
    return e


def _type_ctes(name: str, src: str, keys: str, text: str) -> list[tuple[str, str]]:
    """``name``: (keys, pos, t, word, period, stop, kase) and the type and mark before and after."""
    core = f"regexp_replace(regexp_replace(t, {Q.q(SE.OPENING)}, ''), {Q.q(SE.CLOSING)}, '')"
    w = f"PARTITION BY {keys} ORDER BY pos"
    return [
        (f"{name}0", f"SELECT {keys}, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS pos FROM "
                     f"(SELECT {keys}, {Q.ws_tokens(text)} AS w FROM {src})"),
        (f"{name}1", f"SELECT *, {core} AS core, lower(regexp_replace({core}, '[.!?]+$', '')) AS bare FROM {name}0"),
        (f"{name}2", f"SELECT {keys}, pos, t, CASE WHEN regexp_matches(bare, {Q.q(SE.NUMBER)}) THEN '#' ELSE bare END AS word, "
                     "ends_with(core, '.') AND NOT ends_with(core, '..') AS period, "
                     f"CASE WHEN regexp_matches(t, {Q.q(SE.SOFT)}) THEN '' WHEN ends_with(core, '..') THEN '..' "
                     "WHEN ends_with(core, '.') THEN '.' WHEN ends_with(core, '!') OR ends_with(core, '?') THEN '!' "
                     "ELSE '' END AS stop, CASE WHEN regexp_matches(core, '^\\p{Lu}') THEN 'U' "
                     f"WHEN regexp_matches(core, '^\\p{{Ll}}') THEN 'L' ELSE 'N' END AS kase FROM {name}1"),
        (name, f"SELECT *, coalesce(lag(stop) OVER ({w}), 'start') AS pstop, CASE WHEN lag(stop) OVER ({w}) = '.' "
               f"THEN lag(word) OVER ({w}) END AS pword, lead(word) OVER ({w}) AS nword, lead(kase) OVER ({w}) AS nkase "
               f"FROM {name}2"),
    ]


def _xlog(k: str, n: str, p: str) -> str:
    return (f"((CASE WHEN {k} > 0 THEN {k} * ln({p}) ELSE 0 END) + "
            f"(CASE WHEN {n} - {k} > 0 THEN ({n} - {k}) * ln(1 - {p}) ELSE 0 END))")


def _dunning(c1: str, c2: str, c12: str) -> str:
    rest = f"({c2} - {c12})"
    p, p1, p2 = f"({c2} / n0)", f"({c12} / {c1})", f"({rest} / (n0 - {c1}))"
    return (f"2 * ({_xlog(c12, c1, p1)} + {_xlog(rest, f'(n0 - {c1})', p2)} - {_xlog(c12, c1, p)} - "
            f"{_xlog(rest, f'(n0 - {c1})', p)})")


_TYPE_N = "length(word) - (length(replace(word, '.', '')))"
_LETTERS = "length(replace(word, '.', ''))"
SENTENCE_CTES = [("doc", f"SELECT doc_id, {_abbreviated('text')} AS text FROM documents")] + _type_ctes(
    "ty", "doc", "doc_id", "text") + [
    ("tot", "SELECT count(*)::DOUBLE AS n0, count(*) FILTER (period)::DOUBLE AS k0 FROM ty"),
    ("abc", "SELECT word, count(*) AS n, count(*) FILTER (period) AS n_period, n0, k0 FROM ty, tot GROUP BY word, n0, k0"),
    ("abs", f"SELECT word, n, n_period, 2 * ({_xlog('n_period', 'n', '0.99::DOUBLE')} - {_xlog('n_period', 'n', '(k0 / n0)')}) "
            f"* exp(-{_LETTERS}) * ({_TYPE_N} + 1) * pow({_LETTERS}::DOUBLE, n_period - n) AS score "
            "FROM abc WHERE n_period > 0 AND k0 < n0 AND regexp_matches(word, '\\p{L}')"),
    ("ab", f"SELECT * FROM abs WHERE score >= {SE.ABBREVIATION_SCORE}"),
    ("pl", "SELECT *, CASE WHEN pstop = 'start' THEN 'first' WHEN pstop = '..' OR special THEN 'maybe' WHEN pstop = '' "
           "THEN 'mid' ELSE 'start' END AS place FROM (SELECT *, pstop = '.' AND (pword IN (SELECT word FROM ab) OR "
           "pword = '#' OR regexp_matches(pword, '^\\p{L}$')) AS special FROM ty)"),
    ("wd0", "SELECT word, count(*) AS n, count(*) FILTER (kase = 'L') AS lo, "
            "count(*) FILTER (kase = 'U' AND place = 'mid') AS um, "
            "count(*) FILTER (kase = 'U' AND place IN ('first', 'start')) AS us, "
            "count(*) FILTER (kase = 'L' AND place IN ('first', 'start')) AS ls, "
            "count(*) FILTER (place = 'start') AS ns FROM pl GROUP BY word"),
    ("brk", "SELECT count(*) FILTER (place = 'start')::DOUBLE AS b FROM pl"),
    ("wd1", f"SELECT wd0.*, n0, b, {_dunning('b', 'n', 'ns')} AS score FROM wd0, tot, brk"),
    ("wd", f"SELECT *, score >= {SE.STARTER_SCORE} AND regexp_matches(word, '\\p{{L}}') AND ns / b > n / n0 AS starter FROM wd1"),
    ("co0", "SELECT pword, word, count(*) AS n FROM pl WHERE special GROUP BY pword, word"),
    ("co1", "SELECT co0.*, sum(n) OVER (PARTITION BY pword) AS c1 FROM co0"),
    ("co2", "SELECT co1.pword, co1.word, co1.n, co1.c1::DOUBLE AS c1, wd.n::DOUBLE AS c2, tot.n0 FROM co1 JOIN wd USING (word), tot "
            "WHERE NOT starter"),
    ("co", f"SELECT * FROM (SELECT *, {_dunning('c1', 'c2', 'n')} AS score FROM co2) WHERE score >= {SE.COLLOCATION_SCORE} "
           "AND regexp_matches(word, '\\p{L}|#') AND n / c1 > c2 / n0"),
]


def _ends(ty: str) -> str:
    """Whether each token of ``ty`` ends a sentence."""
    kind = ("CASE WHEN stop = '..' OR word IN (SELECT word FROM ab) THEN 'a' WHEN word = '#' THEN 'n' "
            "WHEN regexp_matches(word, '^\\p{L}$') THEN 'i' END")
    return f"""SELECT x.*, nword IS NULL OR stop = '!' OR (stop IN ('.', '..') AND NOT coalesce(
        (kind IS NOT NULL AND stop = '.' AND (x.word, x.nword) IN (SELECT (pword, word) FROM co)) OR
        CASE kind WHEN 'a' THEN NOT (nkase = 'U' AND ((coalesce(lo, 0) > 0 AND coalesce(um, 0) = 0) OR coalesce(starter, false)))
                  WHEN 'n' THEN nkase = 'L' AND (coalesce(us + um, 0) > 0 OR coalesce(ls, 0) = 0)
                  WHEN 'i' THEN (nkase = 'L' AND (coalesce(us + um, 0) > 0 OR coalesce(ls, 0) = 0))
                                OR (nkase = 'U' AND coalesce(lo, 0) = 0) END, false)) AS ends
        FROM (SELECT *, {kind} AS kind FROM {ty}) x
        LEFT JOIN (SELECT word AS nword, lo, um, us, ls, starter FROM wd) USING (nword)"""


def _split_ctes(name: str, ty: str, keys: str) -> list[tuple[str, str]]:
    return [(f"{name}e", _ends(ty)),
            (f"{name}n", f"SELECT *, coalesce(sum(CAST(ends AS INT)) OVER (PARTITION BY {keys} ORDER BY pos ROWS BETWEEN "
                         f"UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS sent FROM {name}e"),
            (name, f"SELECT {keys}, sent, string_agg(t, ' ' ORDER BY pos) AS sentence FROM {name}n GROUP BY {keys}, sent")]


oracle("sentence_model", _with(SENTENCE_CTES, """
SELECT 'abbreviation' AS kind, word, NULL::VARCHAR AS next, n, round(score, 4) AS score FROM ab
UNION ALL SELECT 'starter', word, NULL, ns, round(score, 4) FROM wd WHERE starter
UNION ALL SELECT 'collocation', pword, word, n, round(score, 4) FROM co"""))
oracle("split_sentences", _with(SENTENCE_CTES + _split_ctes("ss", "ty", "doc_id"),
                                "SELECT doc_id, CAST(sent AS BIGINT) AS pos, sentence FROM ss"))


def _sentence_words() -> list[tuple[str, str]]:
    """``ht`` and ``rt`` of the candidates as the Treebank tokens of their sentences."""
    out = [("sca", f"SELECT {_ROW}, lower({_abbreviated('generated')}) AS g, lower({_abbreviated('question')}) AS q FROM sc")]
    for side, col in (("h", "g"), ("r", "q")):
        out += _type_ctes(f"b{side}t", "sca", _ROW, col) + _split_ctes(f"b{side}s", f"b{side}t", _ROW)
        out.append((f"b{side}w", f"SELECT {_ROW}, flatten(list({Q.treebank_tokens('sentence', True)} ORDER BY sent)) AS w "
                                 f"FROM b{side}s GROUP BY {_ROW}"))
    out.append(("tks", f"SELECT tk.* EXCLUDE (ht, rt), coalesce(bhw.w, []) AS ht, coalesce(brw.w, []) AS rt FROM tk "
                       f"LEFT JOIN bhw USING ({_ROW}) LEFT JOIN brw USING ({_ROW})"))
    return out


def _bleu_sentences() -> str:
    ctes = _metric_ctes("cands", stems=False)
    cut = [n for n, _ in ctes].index("orders")
    bleu = [(n, b.replace("FROM tk", "FROM tks")) for n, b in ctes[cut:] if n != "scored"]
    return _with(SENTENCE_CTES + GEN_CTES + ctes[:2] + _sentence_words() + bleu, f"SELECT {_ROW}, " + ", ".join(
        f"round(bleu{n}, 6) AS bleu{n}" for n in range(1, 5)) + " FROM bleu")


oracle("bleu_sentences", _bleu_sentences())
oracle("predictions_scored", _with(
    GEN_CTES + [("first", "SELECT * FROM cands WHERE rank = 1")] + _metric_ctes("first"),
    f"SELECT {_ROW}, round(rouge_f, 6) AS fmeasure, round(meteor, 6) AS meteor, round(bleu4, 6) AS bleu4 FROM scored"))


def _poisson_weight(u: str) -> str:
    import math
    acc, terms = 0.0, []
    for k in range(17):
        acc += math.exp(-1.0) / math.factorial(k)
        terms.append(f"CASE WHEN {u} >= {acc!r} THEN 1 ELSE 0 END")
    return "(" + " + ".join(terms) + ")"


_U = ("(('0x' || substr(md5('0:' || CAST(pair_id AS VARCHAR) || ':' || CAST((rep - 1) // 4 AS VARCHAR)), "
      "CAST(8 * ((rep - 1) % 4) + 1 AS BIGINT), 8))::BIGINT / 4294967296.0)")
BOOT_CTES = [
    ("bx", "SELECT pair_id, variant, avg(100 * rouge_f) AS x FROM scored GROUP BY pair_id, variant"),
    ("reps", f"SELECT unnest(range(1, {R.BOOTSTRAP_REPLICATES} + 1)) AS rep"),
    ("bw", f"SELECT rep, variant, x, {_poisson_weight(_U)} AS w FROM bx, reps"),
    ("bm", "SELECT rep, variant, sum(w * x) / sum(w) AS mean FROM bw GROUP BY rep, variant HAVING sum(w) > 0"),
]
oracle("bootstrap_rouge", _with(
    METRIC_CTES + BOOT_CTES,
    "SELECT variant, round(quantile_cont(mean, 0.025), 6) AS low, round(quantile_cont(mean, 0.5), 6) AS mid, "
    "round(quantile_cont(mean, 0.975), 6) AS high FROM bm GROUP BY variant"))

LB_CTES = RATED_CTES + [("allc", "SELECT pair_id, rank, variant, generated FROM cands UNION ALL "
                                 "SELECT pair_id, rank, variant, generated FROM ens")] + _metric_ctes("allc")
oracle("leaderboard", _with(LB_CTES + BOOT_CTES + [
    ("lb", "SELECT variant, count(*) AS n, round(100 * avg(rouge_f), 6) AS rouge_l, "
           "round(100 * avg(meteor), 6) AS meteor, " + ", ".join(
               f"round(100 * avg(bleu{n}), 6) AS bleu{n}" for n in range(1, 5))
           + " FROM scored GROUP BY variant"),
    ("md", "SELECT variant, round(quantile_cont(mean, 0.5), 6) AS rouge_mid FROM bm GROUP BY variant"),
], "SELECT *, CAST(rank() OVER (ORDER BY meteor DESC, variant) AS BIGINT) AS rank FROM lb JOIN md USING (variant)"))

# ---------------------------------------------------------------- features (M3)

_PROMPT_CTES = [
    ("p", PAIRS_SQL),
    ("cfg", "SELECT * FROM (VALUES ('BART', '', ' '), ('T5', 'ask question: ', '<sep>')) "
            "AS t(variant, prefix, joiner)"),
    ("pr", "SELECT p.pair_id, cfg.variant, cfg.prefix || p.context || ' </s>' AS prompt, "
           "replace(p.question, '{sep_token}', '<sep>') || ' </s>' AS target FROM p, cfg"),
]
oracle("prompts", _with(_PROMPT_CTES, "SELECT * FROM pr"))


def _fixed(ids: str, max_len: int) -> str:
    body = f"list_concat(list_slice({ids}, 1, {max_len - 1}), [{R.EOS_ID}])"
    return (f"list_concat({body}, list_transform(range({max_len} - len({body})), "
            f"lambda x: {R.PAD_ID}))")


def _mask(ids: str, max_len: int) -> str:
    n = f"least(len({ids}), {max_len - 1}) + 1"
    return (f"list_concat(list_transform(range({n}), lambda x: 1), "
            f"list_transform(range({max_len} - ({n})), lambda x: 0))")


_FEAT_CTES = _PROMPT_CTES + VOCAB_CTES + [
    ("et", "SELECT pair_id, variant, side, unnest(toks) AS token, unnest(range(len(toks))) AS pos "
           "FROM (SELECT pair_id, variant, 0 AS side, " + Q.ws_tokens("prompt") + " AS toks FROM pr "
           "UNION ALL SELECT pair_id, variant, 1 AS side, " + Q.ws_tokens("target") + " AS toks "
           "FROM pr)"),
    ("el", f"SELECT et.pair_id, et.variant, et.side, et.pos, coalesce(v.id, {R.UNK_ID})::INTEGER AS id "
           f"FROM et LEFT JOIN vocab v ON v.token = et.token"),
    ("ids", "SELECT pr.pair_id, pr.variant, "
            "coalesce(list(el.id ORDER BY el.pos) FILTER (WHERE el.side = 0), []) AS src, "
            "coalesce(list(el.id ORDER BY el.pos) FILTER (WHERE el.side = 1), []) AS tgt "
            "FROM pr LEFT JOIN el ON el.pair_id = pr.pair_id AND el.variant = pr.variant "
            "GROUP BY pr.pair_id, pr.variant"),
    ("feat", f"SELECT pair_id, variant, {_fixed('src', R.MAX_INPUT_LEN)} AS input_ids, "
             f"{_mask('src', R.MAX_INPUT_LEN)} AS attention_mask, "
             f"{_fixed('tgt', R.MAX_TARGET_LEN)} AS decoder_input_ids, "
             f"{_mask('tgt', R.MAX_TARGET_LEN)} AS decoder_attention_mask FROM ids"),
]
oracle("encode_features", _with(_FEAT_CTES, "SELECT pair_id, variant, " + ", ".join(
    f"array_to_string({c}, ',') AS {c}" for c in
    ("input_ids", "attention_mask", "decoder_input_ids", "decoder_attention_mask")) + " FROM feat"))
oracle("labels_masked", _with(_FEAT_CTES, "SELECT pair_id, variant, array_to_string("
                              f"list_transform(decoder_input_ids, lambda x: CASE WHEN x = {R.PAD_ID} "
                              f"THEN {R.LABEL_IGNORE} ELSE x END), ',') AS labels, "
                              "CAST(list_sum(attention_mask) AS BIGINT) AS n_input FROM feat"))

oracle("features_stored", _with(_FEAT_CTES, "SELECT pair_id, variant, 'train' AS split, " + ", ".join(
    f"array_to_string({c}, ',') AS {c}" for c in
    ("input_ids", "attention_mask", "decoder_input_ids", "decoder_attention_mask")) + " FROM feat"))

# ---------------------------------------------------------------- sources and sinks (A, C2, E3, G)

oracle("csv_projected", _with([("p", PAIRS_SQL)], "SELECT context, question FROM p"))
oracle("csv_all_columns", PAIRS_SQL)
oracle("csv_row_index", _with([("p", PAIRS_SQL)], "SELECT row_number() OVER (ORDER BY pair_id) - 1 AS row_id, "
                                                  "pair_id, context, question FROM p"))

oracle("csv_splits", _with([("p", PAIRS_SQL)], """
SELECT pair_id, context, question, CASE length(question) % 10 WHEN 0 THEN 'test' WHEN 1 THEN 'valid' ELSE 'train' END
       AS split FROM p"""))

# ---------------------------------------------------------------- keywords (M5)

_CONTENT = (lambda v: f"(regexp_full_match({v}, '\\p{{L}}{{2,}}') AND {v} NOT IN "
                      f"({Q.stop_words_list()}))")


def _edge_ctes(src: str, key: str, text: str, stems: bool = False) -> list[tuple[str, str]]:
    words = f"regexp_extract_all(lower({text}), {Q.q(T.WORD_RUN)})"
    ctes = [
        ("ew", f"SELECT {key}, {words} AS w FROM {src}"),
        ("adj", f"SELECT {key}, unnest(list_transform(range(1, len(w)), "
                "lambda i: {'a': w[i], 'b': w[i + 1]})) AS p FROM ew"),
        ("con", f"SELECT {key}, p.a AS a, p.b AS b FROM adj WHERE {_CONTENT('p.a')} AND {_CONTENT('p.b')}"),
    ]
    nodes = "con"
    if stems:
        ctes += Q.stem_ctes("nstems", "SELECT a AS t FROM con UNION SELECT b FROM con")
        ctes.append(("ncon", f"SELECT con.{key}, x.stem AS a, y.stem AS b FROM con JOIN nstems x ON x.t = con.a "
                             f"JOIN nstems y ON y.t = con.b"))
        nodes = "ncon"
    return ctes + [
        ("und", f"SELECT DISTINCT {key}, least(a, b) AS a, greatest(a, b) AS b FROM {nodes} WHERE a <> b"),
        ("edges", f"SELECT {key}, a AS src, b AS dst FROM und UNION ALL SELECT {key}, b AS src, a AS dst FROM und"),
    ]


def _textrank_ctes(src: str, key: str, text: str, stems: bool = False, iterations: int = 20,
                   d: float = R.TEXTRANK_DAMPING) -> list[tuple[str, str]]:
    ctes = _edge_ctes(src, key, text, stems) + [
        ("deg", f"SELECT {key}, src, count(*) AS deg FROM edges GROUP BY {key}, src"),
        ("we", f"SELECT {key}, src, dst, 1.0 / deg AS w FROM edges JOIN deg USING ({key}, src)"),
        ("r0", f"SELECT {key}, src AS word, 1.0 AS score FROM deg"),
    ]
    for t in range(1, iterations + 1):
        ctes.append((f"r{t}", f"SELECT we.{key}, we.dst AS word, {1 - d} + {d} * sum(we.w * r.score) "
                              f"AS score FROM we JOIN r{t - 1} r ON r.{key} = we.{key} AND "
                              f"r.word = we.src GROUP BY we.{key}, we.dst"))
    return ctes + [
        ("ranked", f"SELECT {key}, word, round(score, 6) AS score, row_number() OVER "
                   f"(PARTITION BY {key} ORDER BY round(score, 6) DESC, word) AS rank, "
                   f"count(*) OVER (PARTITION BY {key}) AS n FROM r{iterations}"),
        ("kept", f"SELECT {key}, CAST(rank AS BIGINT) AS rank, word, score FROM ranked WHERE rank <= floor(0.2 * n)"),
    ]


def _phrase_ctes(src: str, key: str) -> list[tuple[str, str]]:
    """Keyword strings from kept words and the words' first places."""
    return [
        ("kw0", f"SELECT {key}, len(w) AS n, unnest(w) AS word, unnest(range(0, len(w))) AS pos FROM ew"),
        ("kw1", f"SELECT {key}, word, min(pos) AS pos, any_value(n) AS n, any_value(score) AS score "
                f"FROM kw0 JOIN kept USING ({key}, word) GROUP BY {key}, word"),
        ("kw2", f"SELECT *, pos - row_number() OVER (PARTITION BY {key} ORDER BY pos) AS run FROM kw1"),
        ("kw3", f"SELECT *, max(pos) OVER (PARTITION BY {key}, run) = n - 1 AS open FROM kw2"),
        ("kw4", f"SELECT {key}, string_agg(word, ' ' ORDER BY pos) AS phrase, round(avg(score), 9) AS mean, "
                f"min(pos) AS pos FROM kw3 WHERE NOT open OR pos = n - 1 GROUP BY {key}, run"),
        ("kw5", f"SELECT {key}, string_agg(phrase, ' ' ORDER BY mean DESC, pos) AS keywords FROM kw4 GROUP BY {key}"),
        ("kws", f"SELECT {key}, coalesce(keywords, '') AS keywords FROM {src} LEFT JOIN kw5 USING ({key})"),
    ]


oracle("textrank_edges", _with(_edge_ctes("documents", "doc_id", "text"), "SELECT * FROM edges"))
oracle("textrank_keywords", _with(_textrank_ctes("documents", "doc_id", "text"), "SELECT * FROM kept"))


def _converged() -> str:
    """Each text goes on until its largest change is below the tolerance; a loop of weight 0 carries the old rank."""
    d = R.TEXTRANK_DAMPING
    ctes = _edge_ctes("documents", "doc_id", "text") + [
        ("deg", "SELECT doc_id, src, count(*) AS deg FROM edges GROUP BY doc_id, src"),
        ("we", "SELECT doc_id, src, dst, 1.0 / deg AS w, false AS own FROM edges JOIN deg USING (doc_id, src) "
               "UNION ALL SELECT doc_id, src, src, 0.0, true FROM deg"),
        ("it", f"""SELECT doc_id, src AS word, CAST(1.0 AS DOUBLE) AS score, 0 AS step, false AS done FROM deg
            UNION ALL
            SELECT doc_id, word, score, step, max(abs(score - old)) OVER (PARTITION BY doc_id) < 0.0001 OR step >= 100
            FROM (SELECT we.doc_id, we.dst AS word, {1 - d} + {d} * sum(we.w * it.score) AS score,
                         max(it.score) FILTER (WHERE own) AS old, max(it.step) + 1 AS step
                  FROM we JOIN it ON it.doc_id = we.doc_id AND it.word = we.src AND NOT it.done
                  GROUP BY we.doc_id, we.dst)"""),
        ("ranked", "SELECT doc_id, word, round(score, 6) AS score, row_number() OVER "
                   "(PARTITION BY doc_id ORDER BY round(score, 6) DESC, word) AS rank, "
                   "count(*) OVER (PARTITION BY doc_id) AS n FROM it WHERE done")]
    return ("WITH RECURSIVE " + ", ".join(f"{k} AS ({v})" for k, v in ctes)
            + " SELECT doc_id, CAST(rank AS BIGINT) AS rank, word, score FROM ranked WHERE rank <= floor(0.2 * n)")


oracle("textrank_converged", _converged())
oracle("textrank_stems", _with([("p", PAIRS_SQL)] + _textrank_ctes("p", "pair_id", "context", stems=True),
                               "SELECT * FROM kept"))
oracle("keywords_text", _with(_textrank_ctes("documents", "doc_id", "text") + _phrase_ctes("documents", "doc_id"),
                              "SELECT * FROM kws"))
_KW_CFG = ("kcfg", "SELECT * FROM (VALUES ('BART with keywords', '', ' '), ('T5 with keywords', 'ask question: ', "
                   "'<sep>')) AS t(variant, prefix, joiner)")
oracle("prompts_keywords", _with(
    [("p", PAIRS_SQL)] + _textrank_ctes("p", "pair_id", "context") + _phrase_ctes("p", "pair_id") + [_KW_CFG],
    "SELECT pair_id, variant, prefix || context || joiner || keywords || ' </s>' AS prompt, "
    "replace(question, '{sep_token}', '<sep>') || ' </s>' AS target FROM p JOIN kws USING (pair_id), kcfg"))

# ---------------------------------------------------------------- grid, requests (M6, M7)

_GRID_POINTS = [(200.0, 0.02), (200.0, 0.1), (1000.0, 0.02), (1000.0, 0.1)]
_GRID_X = ("SELECT d.n_chars, l.quality, CASE WHEN length(d.text) = 0 THEN NULL ELSE "
           "length(regexp_replace(d.text, '[\\x00-\\x7f]', '', 'g')) / length(d.text) END "
           "AS non_ascii FROM documents d JOIN labels l ON l.doc_id = d.doc_id")
_GRID_RUNS = " UNION ALL ".join(
    f"SELECT CAST({i + 1} AS BIGINT) AS ordinal, {a} AS min_chars, {b} AS max_non_ascii, "
    f"avg(CASE WHEN (CASE WHEN n_chars >= {a} AND coalesce(non_ascii, 0.0) <= {b} THEN 1 ELSE 0 END)"
    f" <> quality THEN 1.0 ELSE 0.0 END) AS loss FROM x"
    for i, (a, b) in enumerate(_GRID_POINTS))
oracle("grid_runs", _with([("x", _GRID_X), ("runs", _GRID_RUNS)],
                          "SELECT ordinal, min_chars, max_non_ascii, round(loss, 6) AS loss FROM runs"))
oracle("grid_best", _with([("x", _GRID_X), ("runs", _GRID_RUNS)],
                          "SELECT ordinal, min_chars, max_non_ascii, round(loss, 6) AS loss FROM runs "
                          "WHERE NOT isnan(loss) ORDER BY loss, ordinal LIMIT 1"))

_MODELS = ", ".join(Q.q(m) for m in R.MODEL_NAMES + [R.COMBINED, "unknown"])
_REQ = (f"SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS request_id, "
        f"CASE WHEN role = 'system' THEN '' ELSE text END AS context, "
        f"CASE WHEN turn = 0 THEN '' WHEN turn = 7 THEN 'seven' ELSE CAST(turn - 1 AS VARCHAR) END AS n, "
        f"([{_MODELS}])[CAST(((conv_id + turn) % 6 + 6) % 6 + 1 AS INTEGER)] AS model "
        f"FROM conversations")
_NAMES = ", ".join(Q.q(m) for m in R.MODEL_NAMES)
oracle("validate_requests", _with([("req", _REQ)], f"""
SELECT request_id,
       CASE WHEN model IN ({_NAMES}) THEN model ELSE 'combined' END AS variant,
       TRY_CAST(n AS INTEGER) AS n_int,
       CASE WHEN coalesce(context, '') = '' THEN {Q.q(R.MSG_EMPTY_CONTEXT)}
            WHEN coalesce(n, '') = '' THEN {Q.q(R.MSG_EMPTY_N)}
            WHEN TRY_CAST(n AS INTEGER) IS NULL THEN {Q.q(R.MSG_BAD_N)} END AS error,
       TRY_CAST(n AS INTEGER) BETWEEN 1 AND 5 AS n_in_range
FROM req"""))


_VALID_CTES = [
    ("req", _REQ),
    ("v", f"""SELECT request_id, context,
       CASE WHEN model IN ({_NAMES}) THEN model ELSE 'combined' END AS variant,
       TRY_CAST(n AS INTEGER) AS n,
       CASE WHEN coalesce(context, '') = '' THEN {Q.q(R.MSG_EMPTY_CONTEXT)}
            WHEN coalesce(n, '') = '' THEN {Q.q(R.MSG_EMPTY_N)}
            WHEN TRY_CAST(n AS INTEGER) IS NULL THEN {Q.q(R.MSG_BAD_N)} END AS error
       FROM req"""),
    ("ok", "SELECT * FROM v WHERE error IS NULL"),
    ("asked", "SELECT * FROM ok WHERE variant LIKE '%with keywords'"),
]
_KEPT_CTES = _VALID_CTES + _textrank_ctes("asked", "request_id", "context")
_ALL_CFG = ("kcfg", "SELECT * FROM (VALUES " + ", ".join(
    f"({Q.q(n)}, {Q.q(p)}, {str(k).lower()}, {Q.q(j)})" for n, p, k, j, _ in R.VARIANTS)
    + ") AS t(variant, prefix, use_keywords, joiner)")
oracle("request_prompts", _with(
    _KEPT_CTES + _phrase_ctes("asked", "request_id") + [_ALL_CFG],
    "SELECT request_id, variant, prefix || context || CASE WHEN use_keywords THEN joiner || coalesce(keywords, '') "
    "ELSE '' END || ' </s>' AS prompt FROM ok JOIN kcfg USING (variant) LEFT JOIN kws USING (request_id)"))

_ANSWER_CTES = _KEPT_CTES + _sentence_ctes("ok", "request_id", "context") + [
    ("sw", f"SELECT request_id, pos, unnest(regexp_extract_all(lower(array_to_string(toks, ' ')), {Q.q(T.WORD_RUN)})) "
           "AS word FROM st"),
    ("hit", "SELECT request_id, pos, count(DISTINCT word) AS hits FROM sw JOIN kept USING (request_id, word) "
            "GROUP BY request_id, pos"),
    ("sg", "SELECT request_id, toks, variant AS model, n, row_number() OVER (PARTITION BY request_id ORDER BY "
           "coalesce(hits, 0) DESC, pos) AS pos FROM st JOIN ok USING (request_id) LEFT JOIN hit USING (request_id, pos)"),
    ("qe", f"SELECT request_id, model, n, pos, 'lead' AS variant, {_as_question('toks')} AS generated FROM sg "
           f"WHERE model NOT LIKE 'T5%' UNION ALL SELECT request_id, model, n, pos, 'cloze', "
           f"{_as_question(_CLOZE_TOKS)} FROM sg WHERE model LIKE 'T5%' OR model = 'combined'"),
    ("qf", "SELECT request_id, model, n, variant, generated, min(pos) AS first_pos FROM qe GROUP BY ALL"),
    ("qr", "SELECT *, row_number() OVER (PARTITION BY request_id, variant ORDER BY first_pos) AS rank FROM qf"),
    ("qn", "SELECT * FROM qr WHERE rank <= n"),
    ("cc", "SELECT request_id, rank, variant, generated FROM qn WHERE model = 'combined'"),
] + VV_CTES + _rated_ctes("cc", "request_id") + [
    ("answered", "SELECT request_id, rank, generated AS question FROM qn WHERE model <> 'combined' UNION ALL "
                 "SELECT request_id, rank, generated FROM ens"),
]
oracle("answer_requests", _with(_ANSWER_CTES, f"""
SELECT request_id, variant, CAST(rank AS BIGINT) AS rank, question,
       CASE WHEN rank IS NULL THEN coalesce(error, {Q.q(R.MSG_MODEL_FAILED)}) END AS error
FROM v LEFT JOIN answered USING (request_id)"""))
# the streaming path answers the same requests micro-batch by micro-batch
oracle("request_stream", ORACLE["answer_requests"])
