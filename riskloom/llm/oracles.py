"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{UPPER.lower()}')"


BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def line_dedup_sql(docs: str, columns: str) -> str:
    """``docs``: a table with doc_id and text; each row gets a number of its own."""
    key = lower_ascii(f"trim(line, {BLANKS})")
    return f"""
    WITH numbered AS (
      SELECT *, row_number() OVER () AS row_no FROM {docs}),
    lines AS (
      SELECT row_no, doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos
      FROM (SELECT row_no, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM numbered)),
    keyed AS (SELECT *, {key} AS key FROM lines),
    common AS (
      SELECT key FROM (SELECT DISTINCT key, doc_id FROM keyed WHERE length(key) >= 1)
      GROUP BY key HAVING count(*) >= 10),
    cleaned AS (
      SELECT row_no, count(*) AS n_lines, count(common.key) AS n_dropped,
        coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE common.key IS NULL), '') AS kept_text
      FROM keyed LEFT JOIN common USING (key) GROUP BY row_no)
    SELECT {columns} FROM numbered JOIN cleaned USING (row_no)
    """


def ngram_components_sql(
    docs: str, columns: str, tail: str = "", n: int = 3, percent: int = 90
) -> str:
    """All pairs that share an n-gram are compared; components by walking the links."""
    word = "'[^\\x20\\x09-\\x0D]+'"
    return f"""
    WITH RECURSIVE worded AS (
      SELECT *, regexp_extract_all({lower_ascii("coalesce(text, '')")}, {word}) AS words FROM {docs}),
    grams AS (
      SELECT DISTINCT doc_id, list_slice(words, i, i + {n - 1}) AS gram
      FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - {n - 2}, 2))) AS i
            FROM worded WHERE len(words) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
    pairs AS (
      SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common
      FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2),
    links AS (
      SELECT u, v FROM pairs JOIN sizes s ON s.doc_id = u JOIN sizes t ON t.doc_id = v
      WHERE 100 * common >= {percent} * (s.n + t.n - common)),
    edges AS MATERIALIZED (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
    reach AS (
      SELECT u AS node, u AS seen FROM edges UNION SELECT node, v FROM reach JOIN edges ON seen = u),
    component AS (SELECT node, min(seen) AS component FROM reach GROUP BY node),
    grouped AS (
      SELECT w.*, coalesce(n, 0) AS n_shingles, coalesce(component, w.doc_id) AS component_id
      FROM worded w LEFT JOIN sizes s ON s.doc_id = w.doc_id LEFT JOIN component c ON c.node = w.doc_id)
    SELECT {columns} FROM grouped {tail}
    """


def decontamination_sql(docs: str, columns: str, tail: str = "") -> str:
    word = "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'"
    return f"""
    WITH numbered AS (
      SELECT *, row_number() OVER () AS row_no,
        regexp_extract_all({lower_ascii("coalesce(text, '')")}, {word}) AS words FROM {docs}),
    items AS (
      SELECT item_id, regexp_extract_all({lower_ascii("coalesce(text, '')")}, {word}) AS words
      FROM benchmark),
    passages AS (
      SELECT DISTINCT item_id, len(words) AS n, words AS w FROM items WHERE len(words) BETWEEN 1 AND 9
      UNION SELECT item_id, 10, list_slice(words, i, i + 9) FROM (
        SELECT item_id, words, unnest(range(1, len(words) - 8)) AS i FROM items WHERE len(words) >= 10)),
    lengths AS (SELECT DISTINCT n FROM passages),
    places AS (
      SELECT row_no, n, i, list_slice(words, i, i + n - 1) AS w
      FROM (SELECT row_no, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM numbered, lengths)),
    met AS (SELECT row_no, i, n, item_id FROM places JOIN passages USING (n, w)),
    hit AS (
      SELECT row_no, count(DISTINCT place) AS n_hit
      FROM (SELECT row_no, unnest(range(i, i + n)) AS place FROM (SELECT DISTINCT row_no, i, n FROM met))
      GROUP BY row_no),
    named AS (
      SELECT row_no, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT row_no, CAST(item_id AS VARCHAR) AS id FROM met WHERE item_id IS NOT NULL)
      GROUP BY row_no),
    marked AS (
      SELECT d.*, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
      FROM numbered d LEFT JOIN hit USING (row_no) LEFT JOIN named USING (row_no))
    SELECT {columns} FROM marked {tail}
    """


def license_sql() -> str:
    """Every window of words is held against every notice that its whole text could hold."""
    from riskloom.llm.license_scan import NOTICES, PHRASES, TELLING

    word = "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'"
    phrases = " UNION ALL ".join(
        f"SELECT '{label}' AS label, {phrase.split()} AS w" for phrase, label in PHRASES
    )
    telling = lambda words: [w for w in TELLING if w in words] or "CAST([] AS VARCHAR[])"
    notices = " UNION ALL ".join(
        f"SELECT '{label}' AS label, list_distinct({notice.split()}) AS w, "
        f"{telling(notice.split())} AS told, {-(-3 * len(notice.split()) // 2)} AS size"
        for label, notice in NOTICES
    )
    return f"""
    WITH phrases AS ({phrases}), notices AS ({notices}),
    worded AS (
      SELECT *, row_number() OVER () AS row_no,
        regexp_extract_all({lower_ascii("coalesce(text, '')")}, {word}) AS words FROM documents),
    places AS (
      SELECT row_no, label, i - 1 AS place
      FROM (SELECT row_no, words, unnest(range(1, len(words) + 1)) AS i FROM worded
            WHERE list_has_any(words, ['cc', 'license', 'reserved'])), phrases
      WHERE list_slice(words, i, i + len(w) - 1) = w),
    based AS (
      SELECT row_no, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY row_no),
    likely AS (
      SELECT row_no, label, w, told, size, words FROM worded, notices
      WHERE list_has_all(words, told) AND 100 * len(list_intersect(w, words)) >= 80 * len(w)),
    blocks AS (
      SELECT row_no, label, w, told, list_slice(words, i, i + size - 1) AS block
      FROM (SELECT *, unnest(range(1, len(words) + 1)) AS i FROM likely)),
    noticed AS (
      SELECT row_no, label, max(len(list_intersect(w, block)) / len(w)) AS share FROM blocks
      WHERE list_has_all(block, told) AND 100 * len(list_intersect(w, block)) >= 80 * len(w) GROUP BY 1, 2),
    labelled AS (
      SELECT row_no, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
      FROM (SELECT row_no, label FROM noticed UNION SELECT row_no, label FROM places) GROUP BY row_no),
    best AS (SELECT row_no, max(share) AS share FROM noticed GROUP BY row_no)
    SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
      coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
      CASE WHEN n_base > 0 THEN CAST(1 AS DOUBLE) ELSE coalesce(share, 0) END AS score
    FROM worded LEFT JOIN based USING (row_no) LEFT JOIN labelled USING (row_no) LEFT JOIN best USING (row_no)
    """


def source_mixing_sql(docs: str, columns: str, tail: str = "") -> str:
    return f"""
    WITH sized AS (
      SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
        md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place FROM {docs}),
    sources AS (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(3 * sum(size) AS BIGINT) AS most,
        CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight
      FROM sized GROUP BY source),
    placed AS (
      SELECT *, row_number() OVER by_need AS nth,
        CAST(sum(source_size) OVER () - coalesce(sum(most) OVER (by_need ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rest,
        CAST(sum(weight) OVER (by_need ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS heavy
      FROM sources WINDOW by_need AS (ORDER BY most / weight, source NULLS LAST)),
    level AS (SELECT nth AS level_nth, rest AS level_rest, heavy AS level_heavy FROM placed
      WHERE most * heavy >= rest * weight ORDER BY nth LIMIT 1),
    targets AS (
      SELECT source, source_size, CASE WHEN nth < level_nth THEN CAST(most AS DOUBLE)
        ELSE level_rest * weight / level_heavy END AS target FROM placed, level),
    queued AS (
      SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, doc_id NULLS FIRST, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS ahead FROM sized),
    timed AS (
      SELECT q.*, t.source_size, t.target, row_number() OVER () AS row_no,
        CASE WHEN target > 0 THEN (ahead + size) / target END AS finish
      FROM queued q JOIN targets t ON q.source IS NOT DISTINCT FROM t.source),
    turns AS (
      SELECT row_no, source, target, size, ahead + lap * source_size AS start,
        CAST(ceil(size / 1024) AS BIGINT) AS piece
      FROM timed, range(3) AS laps(lap) WHERE size > 0 AND ahead + lap * source_size < target),
    servings AS (
      SELECT row_no, source, (start + size) / target AS done, size AS words FROM turns WHERE start + size <= target
      UNION ALL
      SELECT row_no, source, (start + least(size, k * piece)) / target, least(size, k * piece) - least(size, (k - 1) * piece)
      FROM (SELECT *, unnest(range(1, CAST(ceil(size / piece) AS BIGINT) + 1)) AS k FROM turns WHERE start + size > target)),
    ordered AS (
      SELECT row_no, words, (SELECT sum(size) FROM sized) - coalesce(sum(words) OVER (ORDER BY done, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over FROM servings),
    took AS (
      SELECT row_no, CAST(sum(greatest(0, least(words, left_over))) AS BIGINT) AS taken FROM ordered GROUP BY row_no),
    served AS (SELECT * REPLACE (coalesce(taken, 0) AS taken) FROM timed LEFT JOIN took USING (row_no))
    SELECT {columns} FROM served {tail}
    """


def quality_sql(docs: str, columns: str, tail: str = "") -> str:
    from riskloom.llm.quality import FURNITURE

    word = "'[^\\x20\\x09-\\x0D]+'"
    small = lower_ascii("x")
    named = " OR ".join(f"contains({small}, '{p}')" for p in FURNITURE)
    phrases = f"(length(x) - length(regexp_replace({small}, '{'|'.join(FURNITURE)}', '', 'g')))"
    n_words, whole = f"len(regexp_extract_all(x, {word}))", f"length(trim(x, {BLANKS}))"
    solid = "regexp_replace(x, '[\\x20\\x09-\\x0D]+', '', 'g')"
    marks = """(length(x) - length(translate(x, '#*$%&<>{}~^=', ''))
      + length(x) - length(regexp_replace(x, '[!?]{2,}', '', 'g')))"""
    separators = "(length(x) - length(translate(x, '|»·•', '')))"
    failing = f"""(({marks} > 0 AND {marks} > length({solid}) * 0.15)
      OR ({separators} >= 3 AND {separators} > {n_words} * 0.25)
      OR (({named}) AND ({n_words} <= 8 OR {phrases} > {whole} * 0.3)))"""
    return f"""
    WITH numbered AS (SELECT *, row_number() OVER () AS row_no FROM {docs}),
    shaped AS (
      SELECT *, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), {word}) AS words,
        string_split(coalesce(text, ''), chr(10)) AS all_lines FROM numbered),
    windows AS (
      SELECT row_no, i, list_slice(words, i, i + 4) AS w
      FROM (SELECT row_no, words, unnest(range(1, len(words) - 3)) AS i FROM shaped)),
    repeated AS (SELECT row_no, i FROM (
        SELECT row_no, i, count(*) OVER (PARTITION BY row_no, w) AS n FROM windows) WHERE n >= 2),
    covered AS (
      SELECT row_no, count(DISTINCT i + k) AS n_repeat FROM repeated, range(5) AS r(k) GROUP BY row_no),
    lines AS (SELECT row_no, unnest(all_lines) AS x, unnest(range(len(all_lines))) AS pos FROM shaped),
    judged AS (
      SELECT row_no, count(*) FILTER (WHERE has) - count(DISTINCT x) FILTER (WHERE has) AS n_dup,
        string_agg(x, chr(10) ORDER BY pos) FILTER (WHERE NOT fails) AS good
      FROM (SELECT *, regexp_matches(x, {word}) AS has, {failing} AS fails FROM lines) GROUP BY row_no),
    counted AS (
      SELECT s.*, len(words) AS n_words, length({solid.replace('(x', '(body')}) AS word_chars,
        length(body) - length(translate(body, '#*$%&|<>', '')) AS n_symbols,
        n_dup AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words,
        CASE WHEN text IS NOT NULL THEN coalesce(good, '') END AS clean_text,
        length({solid.replace('(x', "(coalesce(good, '')")}) AS left_chars
      FROM shaped s JOIN judged USING (row_no) LEFT JOIN covered USING (row_no)),
    verdict AS (
      SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
        CASE WHEN word_chars > 0 THEN 1 - left_chars / word_chars ELSE 0 END AS lost_share FROM counted),
    final AS (SELECT *, NOT base_failed AND lost_share <= 0.5 AS kept FROM verdict)
    SELECT {columns} FROM final {tail}
    """


CHAT_FORMAT_SQL = """
WITH turns AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
plain AS (SELECT conv_id, turn, role AS r0, text AS t0, coalesce(role, '') AS role, coalesce(text, '') AS text FROM turns),
sized AS (SELECT *, length(text) + length(text) - length(replace(replace(text, chr(92), ''), '|', '')) AS text_chars,
  length(role) + length(role) - length(replace(replace(replace(role, chr(92), ''), '|', ''), chr(10), '')) AS role_chars FROM plain),
together AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST) AS all_text,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST) FILTER (WHERE role = 'assistant'), '') AS learned,
    CAST(sum(12 + role_chars + 1 + text_chars + 11) AS BIGINT) AS formatted_chars,
    string_agg(role, ' ' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST) AS roles
  FROM sized GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(all_text) AS turns_sha256, length(learned) AS loss_chars,
  sha256(learned) AS loss_sha256, formatted_chars,
  regexp_full_match(roles, '(system )?user assistant( user assistant)*') AS valid
FROM together
"""


HARD_NEGATIVES_SQL = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
found AS (
  SELECT anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS nth
  FROM positives JOIN scores USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, CAST(nth AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM found WHERE nth <= 5
"""


SOURCE_DIVERGENCE_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({lower_ascii("coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
held AS (
  SELECT row_no, lang, source, term, count(*) AS n
  FROM (SELECT row_no, lang, source, unnest(terms) AS term FROM docs) GROUP BY ALL),
kept AS (
  SELECT lang, term, sum(n) AS lang_n FROM held GROUP BY lang, term HAVING count(*) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
own AS (
  SELECT lang, source, term, sum(n) AS n FROM held SEMI JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (
  SELECT lang, source, coalesce(sum(n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN own USING (lang, source) GROUP BY ALL),
shares AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, lang_n, lang_total, v,
    CAST(1 + 1000000000 * (coalesce(n, 0) + 1) // (total + v) AS BIGINT) AS p
  FROM totals JOIN langs USING (lang) JOIN kept USING (lang) LEFT JOIN own USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(d.value, 0) AS BIGINT) AS value
  FROM totals a JOIN totals b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) d
  ON d.lang = a.lang AND d.source = a.source AND d.item = b.source),
against AS (
  SELECT lang, source, term, n, p, CAST(1 + 1000000000 * (lang_n + 1) // (lang_total + v) AS BIGINT) AS q
  FROM shares),
terms AS (
  SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM against WHERE n > 0 AND p > q),
parts AS (SELECT *, 'pair' AS part FROM pairs UNION ALL SELECT *, 'term' AS part FROM terms)
SELECT lang, source, part, item, value, CAST(nth AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS nth FROM parts)
WHERE part = 'pair' OR nth <= 200
"""


def oracles() -> dict[str, str]:
    return {
        "op1_line_dedup": line_dedup_sql(
            "documents", "doc_id, n_lines, n_dropped, sha256(kept_text) AS kept_sha256"
        ),
        "op2_ngram_jaccard_join": ngram_components_sql(
            "documents", "doc_id, n_shingles, component_id"
        ),
        "op3_license_scan": license_sql(),
        "op6_benchmark_decontamination": decontamination_sql(
            "documents", "doc_id, n_words, n_hit, n_items, items_sha256, contaminated"
        ),
        "op8_source_mixing": source_mixing_sql(
            "documents", "doc_id, size, source_size, target, taken, finish"
        ),
        "op9_quality_rules": quality_sql(
            "documents",
            "doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept",
        ),
        "op10_chat_format": CHAT_FORMAT_SQL,
        "op12_hard_negatives": HARD_NEGATIVES_SQL,
        "op13_source_divergence": SOURCE_DIVERGENCE_SQL,
    }
