"""DuckDB SQL of the queries that SQL can express."""

from sunsieve.llm.divergence import COMMON_WORDS, N_COMMON, Limits
from sunsieve.llm.perspectives import CLOSE, FRAME, NOBODY, OPEN


def _words_of(k: int) -> str:
    cases = " ".join(f"WHEN '{lang}' THEN '{words[k]}'" for lang, words in COMMON_WORDS.items())
    return f"CASE lang {cases} END"


def _js(shares: list[str], reference: list[str]) -> str:
    def part(x: str, y: str) -> str:
        return f"CASE WHEN {x} > 0 THEN ({x}) * log2(2 * ({x}) / (({x}) + ({y}))) ELSE 0 END"

    terms = " + ".join(f"{part(p, q)} + {part(q, p)}" for p, q in zip(shares, reference))
    return f"sqrt(greatest(0, ({terms}) / 2))"


def divergence_sql(limits: Limits = Limits()) -> str:
    """Base counts, histograms, language references and verdicts of all documents."""
    classes = ["n_upper", "n_digits", "n_symbols", "n_marks", "n_others"]
    common = [f"common_{k}" for k in range(N_COMMON)]
    langs = ", ".join(f"'{x}'" for x in COMMON_WORDS)
    spelt = sorted({w for words in COMMON_WORDS.values() for w in words})
    spelt = ", ".join(f"'{x}'" for x in [*spelt, *(w.capitalize() for w in spelt)])
    counted = ", ".join(f"count(*) FILTER (lower(word) = {_words_of(k)}) AS common_{k}" for k in range(N_COMMON))
    zero = ", ".join(f"coalesce(common_{k}, 0) AS common_{k}" for k in range(N_COMMON))
    sums = ", ".join(f"sum({c}) AS r_{c}" for c in (*classes, *common, "n_words", "word_chars"))
    chars = _js([f"{c} / word_chars" for c in classes], [f"r_{c} / r_word_chars" for c in classes])
    own, theirs = " - ".join(["n_words", *common]), " - ".join(["r_n_words", *(f"r_{c}" for c in common)])
    words = _js(
        [*(f"{c} / n_words" for c in common), f"({own}) / n_words"],
        [*(f"r_{c} / r_n_words" for c in common), f"({theirs}) / r_n_words"],
    )
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, CASE WHEN lang IN ({langs}) THEN lang END AS lang, coalesce(text, '') AS text
  FROM documents
), w AS (
  SELECT rid, lang, unnest(regexp_split_to_array(text, '[\x20\x09-\x0D]+')) AS word,
    generate_subscripts(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), 1) AS i
  FROM d
), v AS (
  SELECT rid, lang, word, row_number() OVER (PARTITION BY rid ORDER BY i) AS i FROM w WHERE word <> ''
), per AS (
  SELECT rid, count(*) AS n_words, sum(length(word)) AS word_chars,
    sum(length(word) - length(regexp_replace(word, '\p{{Lu}}', '', 'g'))) AS n_upper,
    sum(length(word) - length(regexp_replace(word, '[0-9]', '', 'g'))) AS n_digits,
    sum(length(word) - length(regexp_replace(word, '[!-/:-@\[-`{{-~]', '', 'g'))) AS n_ascii
  FROM v GROUP BY rid
), com AS (
  SELECT rid, {counted} FROM v WHERE word IN ({spelt}) GROUP BY rid
), tri AS (
  SELECT rid, i, word AS a, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c FROM v
  WINDOW o AS (PARTITION BY rid ORDER BY i)
), again AS (
  SELECT rid, i FROM tri WHERE c IS NOT NULL QUALIFY count(*) OVER (PARTITION BY rid, a, b, c) > 1
), covered AS (
  SELECT rid, count(DISTINCT j) AS n_repeat_words FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM again) GROUP BY rid
), lines AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid
), f AS (
  SELECT d.doc_id, d.lang, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_upper, 0) AS n_upper, coalesce(n_digits, 0) AS n_digits, coalesce(n_ascii, 0) AS n_ascii, {zero}
  FROM d LEFT JOIN per USING (rid) LEFT JOIN com USING (rid) LEFT JOIN covered USING (rid) LEFT JOIN lines USING (rid)
), g AS (
  SELECT *, n_ascii - n_symbols AS n_marks, word_chars - n_upper - n_digits - n_ascii AS n_others,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM f
), r AS (
  SELECT lang, {sums} FROM g WHERE lang IS NOT NULL AND NOT base_failed GROUP BY lang
), j AS (
  SELECT g.*,
    CASE WHEN r_n_words > 0 AND word_chars >= {limits.least_chars} THEN {chars} END AS char_distance,
    CASE WHEN r_n_words > 0 AND n_words >= {limits.least_words} THEN {words} END AS word_distance
  FROM g LEFT JOIN r USING (lang)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  round(char_distance, 6) AS char_distance, round(word_distance, 6) AS word_distance,
  NOT base_failed AND coalesce(char_distance <= {limits.char_distance}, true)
    AND coalesce(word_distance <= {limits.word_distance}, true) AS kept
FROM j
"""


def archives_sql(least: int = 100) -> str:
    """What every page's record says: the smallest page_id of equal payloads is the response."""
    return f"""
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= {least} THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""


def perspectives_sql() -> str:
    """Every dialogue once for each of its participants, a row per message."""
    return f"""
WITH m AS (
  SELECT conv_id, turn, CASE WHEN trim(role) <> '' THEN role ELSE '{NOBODY}' END AS speaker, coalesce(text, '') AS text
  FROM conversations
), w AS (
  SELECT DISTINCT conv_id, speaker AS perspective FROM m WHERE speaker <> '{FRAME}'
), r AS (
  SELECT m.*, perspective,
    CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = '{FRAME}' THEN '{FRAME}' ELSE 'user' END AS role
  FROM m JOIN w ON m.conv_id IS NOT DISTINCT FROM w.conv_id
), h AS (
  SELECT *, '{OPEN}' || role || CASE WHEN role = 'user' THEN ' name=' || speaker ELSE '' END || chr(10) AS head FROM r
), s AS (
  SELECT *, head || text || '{CLOSE}' || chr(10) AS segment FROM h
), p AS (
  SELECT *, CAST(sum(length(segment)) OVER (
    PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stop
  FROM s
)
SELECT conv_id, perspective, turn, speaker, role, segment, stop - length(segment) AS start, stop AS "end",
  CASE WHEN role = 'assistant' THEN stop - length(segment) + length(head) ELSE stop END AS mask_start,
  CASE WHEN role = 'assistant' THEN stop - 1 ELSE stop END AS mask_end
FROM p
"""


def negatives_sql() -> str:
    """Every anchor's positives, and the best rows of other labels in the window of each."""
    return """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS own,
    CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT own AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
