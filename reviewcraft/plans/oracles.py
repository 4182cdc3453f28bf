"""The same queries in SQL for DuckDB, written independently of the Spark plans.

RE2 has no lookaround and no backreferences. Word edges are made explicit by
framing each word with two private-use characters; runs of one character are
matched per character.
"""

from __future__ import annotations

from reviewcraft import fixed_values as fv
from reviewcraft.plans.queries import DAILY_SHARE, TARGET, TRANSLATABLE

_OPEN, _SHUT = chr(0xE000), chr(0xE001)
_WS = f"[{fv.WHITESPACE_CLASS}]+"
_NOT_WS = f"[^{fv.WHITESPACE_CLASS}]+"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _sub(expr: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({expr}, {_text(pattern)}, {_text(replacement)}, 'g')"


def _strip(expr: str) -> str:
    return f"trim({expr}, {_text(fv.WHITESPACE_CHARS)})"


def _collapse(expr: str) -> str:
    return _strip(_sub(expr, _WS, " "))


def _html(expr: str) -> str:
    return _sub(expr, fv.HTML_TAG, " ")


def _urls(expr: str) -> str:
    return _sub(expr, fv.URL, " ")


def _clean(expr: str) -> str:
    return _collapse(_urls(_html(expr)))


def _framed(expr: str) -> str:
    return _sub(expr, f"([{fv.WORD_CLASS}]+)", rf"{_OPEN}\1{_SHUT}")


def _unframed(expr: str) -> str:
    return _sub(expr, f"[{_OPEN}{_SHUT}]", "")


def _dots(expr: str) -> str:
    pair = rf"([{fv.LETTERS}])\.([{fv.LETTERS}])"
    return _sub(_sub(expr, pair, r"\1 \2"), pair, r"\1 \2")


def _mash(expr: str) -> str:
    word = f"{_OPEN}[{fv.MASH_CONSONANTS}]{{{fv.MASH_MIN_LENGTH},}}{_SHUT}"
    return _unframed(_sub(_framed(expr), word, ""))


def _letter_runs(expr: str) -> str:
    letters = [chr(c) for c in (*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1))]
    for letter in [*letters, *"çğıöşüÇĞIÖŞÜ"]:
        expr = _sub(expr, f"{letter}{{3,}}", letter)
    return expr


def _punct_runs(expr: str) -> str:
    for mark in fv.REPEATABLE_PUNCTUATION:
        expr = _sub(expr, f"[{mark}]{{2,}}", mark)
    return expr


def _plural(expr: str) -> str:
    word = f"[{fv.LETTERS}{fv.CASE_FOLDED_EXTRAS}]+"
    pattern = f"{_OPEN}({word}){_SHUT}{_WS}{_OPEN}({fv.PLURAL_SUFFIX}){_SHUT}"
    return _unframed(_sub(_framed(expr), pattern, r"\1\2"))


def _tight(expr: str) -> str:
    return _sub(expr, f"{_WS}([{fv.TIGHT_PUNCTUATION}])", r"\1")


def _normalized(expr: str) -> str:
    expr = f"coalesce({expr}, '')"
    for step in (_dots, _mash, _letter_runs, _punct_runs, _plural, _tight, _collapse):
        expr = step(expr)
    return expr


def _tokens(expr: str) -> str:
    return f"regexp_extract_all({expr}, {_text(_NOT_WS)})"


_ENTROPY = "coalesce(list_entropy(string_split({0}, '')), 0.0)"

_PLACE = "CAST(floor(sqrt(doc_id)) AS BIGINT)"
_REVIEWS = f"""
    SELECT doc_id AS review_id,
           concat('place_', {_PLACE}) AS place_id,
           concat('Place ', {_PLACE}) AS place_name,
           CASE doc_id % 3 WHEN 0 THEN 'cafe' WHEN 1 THEN 'restaurant' ELSE 'bakery' END AS category,
           CAST(n_chars % 5 + 1 AS DOUBLE) AS rating,
           lang AS detected_lang,
           text AS cleaned_text
    FROM documents"""
_MARKED_UP = "SELECT page_id, concat_ws(' ', url, html) AS review_text FROM pages"


def _judged(source: str) -> str:
    """``source`` with reject_reason."""
    consonants = f"[{fv.TURKISH_CONSONANTS}]{{{fv.MAX_CONSECUTIVE_CONSONANTS},}}"
    return f"""
    SELECT * EXCLUDE (words, letters, vowels),
        CASE
            WHEN cleaned_text IS NULL OR length(cleaned_text) < {fv.MIN_CHARS} THEN 'too_short'
            WHEN len(words) < {fv.MIN_WORD_COUNT} THEN 'too_few_words'
            WHEN len(words) >= {fv.REPETITION_MIN_WORDS}
                AND len(list_distinct(words)) / len(words) < {fv.MIN_DISTINCT_WORD_SHARE}
                THEN 'repeated_words'
            WHEN len(list_filter(words, lambda w: regexp_matches(w, {_text(consonants)})))
                / len(words) > {fv.MAX_BAD_WORD_RATIO} THEN 'consonant_runs'
            WHEN letters >= {fv.VOWEL_MIN_LETTERS} AND vowels / letters <
                CASE WHEN len(words) >= {fv.LONG_REVIEW_WORDS} THEN 0.12::DOUBLE
                     ELSE 0.15::DOUBLE END THEN 'few_vowels'
            WHEN length(cleaned_text) > {fv.ENTROPY_MIN_CHARS}
                AND {_ENTROPY.format("cleaned_text")} < {fv.MIN_ENTROPY_BITS} THEN 'low_entropy'
        END AS reject_reason
    FROM (
        SELECT *, {_tokens("cleaned_text")} AS words,
               length({_sub("cleaned_text", chr(92) + "P{L}+", "")}) AS letters,
               length({_sub("cleaned_text", f"[^{fv.TURKISH_VOWELS}]+", "")}) AS vowels
        FROM ({source}))"""


_CURATED = f"""
    SELECT review_id, place_id, place_name, category, rating, detected_lang, cleaned_text
    FROM ({_judged(f"SELECT * REPLACE ({_normalized('cleaned_text')} AS cleaned_text) FROM ({_REVIEWS})")})
    WHERE reject_reason IS NULL"""


def _scored(source: str) -> str:
    return f"""
    SELECT *, CASE WHEN word_count < {fv.IDEAL_MIN_WORDS} THEN word_count * 0.5::DOUBLE
                   WHEN word_count > {fv.IDEAL_MAX_WORDS} THEN {fv.IDEAL_MAX_WORDS}.0::DOUBLE
                   ELSE word_count::DOUBLE END AS info_score
    FROM (SELECT *, len({_tokens("cleaned_text")})::INTEGER AS word_count FROM ({source}))"""


def _sampled(source: str, most: int) -> str:
    return f"""
    SELECT * FROM (
        SELECT *,
            row_number() OVER (PARTITION BY place_id, rating
                               ORDER BY info_score DESC, review_id)::INTEGER AS rn,
            count(*) OVER (PARTITION BY place_id) AS n,
            round_even(count(rating) OVER (PARTITION BY place_id, rating)
                / count(rating) OVER (PARTITION BY place_id) * {most}, 0) AS alloc
        FROM ({_scored(source)}) WHERE place_id IS NOT NULL)
    WHERE n >= {fv.MIN_REVIEWS_PER_PLACE} AND (n <= {most} OR rn <= alloc)"""


def _metadata(source: str) -> str:
    return f"""
    SELECT place_id, arg_min(place_name, review_id) AS place_name,
           count(*) AS total_reviews_analyzed,
           round_even(avg(rating) * 100, 0) / 100 AS avg_rating
    FROM ({source}) WHERE place_id IS NOT NULL GROUP BY place_id"""


def _contexts(source: str = _REVIEWS, most: int = fv.MAX_REVIEWS_PER_PLACE) -> str:
    line = (
        f"concat({_text(fv.LINE_PREFIX)}, trunc(rating)::INTEGER, "
        f"{_text(fv.LINE_MIDDLE)}, cleaned_text)"
    )
    return f"""
    SELECT place_id, llm_input_context, place_name, total_reviews_analyzed, avg_rating
    FROM (SELECT place_id, string_agg({line}, chr(10)
                     ORDER BY md5(concat('{fv.SEED}:', review_id)), {line}) AS llm_input_context
          FROM ({_sampled(source, most)}) GROUP BY place_id)
    JOIN ({_metadata(source)}) USING (place_id)"""


_PENDING = f"""
    SELECT * FROM ({_contexts()}) WHERE place_id NOT IN (
        SELECT place_id FROM ({_metadata(_REVIEWS)}) WHERE avg_rating < 3)"""

_EXTRACTED = f"""
    SELECT place_id, place_name, llm_input_context AS input_context, target_summary
    FROM ({_contexts()})
    JOIN (
        SELECT place_id, string_agg(line, ' ' ORDER BY rn) AS target_summary
        FROM (
            SELECT place_id, line, row_number() OVER (PARTITION BY place_id ORDER BY
                       CASE WHEN w < {fv.IDEAL_MIN_WORDS} THEN w * 0.5
                            ELSE least(w, {fv.IDEAL_MAX_WORDS}) END DESC, pos) AS rn
            FROM (
                SELECT place_id, pos, line, len({_tokens("line")}) AS w
                FROM (SELECT place_id,
                             unnest(string_split(llm_input_context, chr(10))) AS line,
                             generate_subscripts(string_split(llm_input_context, chr(10)), 1) AS pos
                      FROM ({_contexts()}))
                WHERE line <> ''))
        WHERE rn <= 3 GROUP BY place_id) USING (place_id)"""


def _detected(source: str, key: str, text: str) -> str:
    """``source`` with detected_lang, trained on four fifths of documents."""

    def grams(table: str, columns: str, body: str) -> str:
        letters = _sub(f"concat(' ', lower({body}), ' ')", r"\P{L}+", " ")
        return f"""
        SELECT {columns}, gram FROM (
            SELECT {columns}, unnest([a, a || b, a || b || c]) AS gram FROM (
                SELECT {columns}, ch AS a,
                       lead(ch, 1) OVER w AS b, lead(ch, 2) OVER w AS c
                FROM (SELECT {columns}, unnest(chars) AS ch,
                             generate_subscripts(chars, 1) AS pos
                      FROM (SELECT {columns}, string_split({letters}, '') AS chars
                            FROM ({table})))
                WINDOW w AS (PARTITION BY {columns} ORDER BY pos)))
        WHERE gram <> ' ' AND NOT (length(gram) = 3 AND substring(gram, 2, 1) = ' ')"""

    return f"""
    WITH train_grams AS (
        SELECT lang, gram, count(*) AS n
        FROM ({grams("SELECT doc_id, lang, text FROM documents WHERE lang IS NOT NULL AND doc_id % 5 <> 0",
                     "doc_id, lang", "text")}) GROUP BY ALL),
    langs AS (SELECT lang, sum(n) AS total FROM train_grams GROUP BY lang),
    sizes AS (SELECT count(DISTINCT gram) AS v FROM train_grams),
    weights AS (
        SELECT g.gram, l.lang, CAST(round_even((ln(coalesce(t.n, 0) + 0.5::DOUBLE)
                   - ln(l.total + 0.5::DOUBLE * v)) * 1e6, 0) AS BIGINT) AS weight
        FROM (SELECT DISTINCT gram FROM train_grams) g CROSS JOIN langs l CROSS JOIN sizes
        LEFT JOIN train_grams t ON t.gram = g.gram AND t.lang = l.lang),
    counts AS (
        SELECT {key}, gram, count(*) AS n FROM ({grams(
            f"SELECT * FROM ({source}) WHERE length({_strip(text)}) >= {fv.MIN_DETECTABLE_CHARS}",
            key, text)}) GROUP BY ALL),
    labels AS (
        SELECT {key}, lang FROM (
            SELECT {key}, lang, row_number() OVER (
                PARTITION BY {key} ORDER BY sum(n * weight) DESC, lang) AS best
            FROM counts JOIN weights USING (gram) GROUP BY {key}, lang)
        WHERE best = 1)
    SELECT s.*, coalesce(labels.lang, '{fv.UNKNOWN_LANGUAGE}') AS detected_lang
    FROM ({source}) s LEFT JOIN labels USING ({key})"""


_ALLOWED = ", ".join(_text(lang) for lang in sorted({TARGET, *TRANSLATABLE}))
_RAW_CLEAN = f"""
    SELECT review_id, place_id, rating, raw_text, {_clean("raw_text")} AS review_text
    FROM (SELECT * EXCLUDE (cleaned_text, detected_lang), {_strip("cleaned_text")} AS raw_text
          FROM ({_REVIEWS}))
    WHERE raw_text <> ''"""
_PAGES_CLEAN = f"""
    SELECT page_id, raw_text, {_clean("raw_text")} AS review_text
    FROM (SELECT page_id, {_strip("review_text")} AS raw_text FROM ({_MARKED_UP}))
    WHERE raw_text <> ''"""

_ANSWERED = """
    SELECT concat_ws('-', a.conv_id, a.turn) AS place_id, a.text AS input_context,
           b.text AS target_summary
    FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn + 1 = b.turn
    WHERE a.role = 'user' AND b.role = 'assistant'"""
_USER = f"concat({_text(fv.CHAT_USER_PREFIX)}, input_context)"
_MESSAGES = f"""CAST(to_json([
    {{'role': 'system', 'content': {_text(fv.CHAT_SYSTEM_PROMPT)}}},
    {{'role': 'user', 'content': {_USER}}},
    {{'role': 'assistant', 'content': target_summary}}]) AS VARCHAR)"""


def _turn(role: str, content: str) -> str:
    return f"'{fv.CHAT_TURN_START}{role}', chr(10), {content}, '{fv.CHAT_TURN_END}', chr(10)"


_RENDERED = f"""
    SELECT place_id, concat({_turn("system", _text(fv.CHAT_SYSTEM_PROMPT))},
        {_turn("user", _USER)}, {_turn("assistant", "target_summary")}) AS text
    FROM ({_ANSWERED})"""


def _is_test(key: str) -> str:
    return (
        f"row_number() OVER (ORDER BY md5(concat('{fv.SEED}:', {key})))"
        f" <= ceil(count(*) OVER () * {fv.TEST_SIZE}::DOUBLE)"
    )


_FLAGGED = f"""
    SELECT review_id, detected_lang <> '{TARGET}' AS is_translated, detected_lang, cleaned_text
    FROM ({_REVIEWS})"""

_GLOSSARY = f"""
    WITH ranked AS (
        SELECT lang, token, row_number() OVER (PARTITION BY lang ORDER BY n DESC, token) AS rank
        FROM (SELECT lang, token, count(*) AS n
              FROM (SELECT lang, unnest({_tokens("text")}) AS token FROM documents) GROUP BY ALL)
        ),
    glossary AS (
        SELECT f.lang, f.token, t.token AS translation
        FROM ranked f JOIN ranked t ON f.rank = t.rank
        WHERE f.lang <> '{TARGET}' AND t.lang = '{TARGET}'),
    words AS (
        SELECT doc_id, lang, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos
        FROM (SELECT doc_id, lang, {_tokens("text")} AS toks FROM documents
              WHERE lang <> '{TARGET}'))
    SELECT doc_id, string_agg(coalesce(translation, token), ' ' ORDER BY pos) AS cleaned_text
    FROM words LEFT JOIN glossary USING (lang, token) GROUP BY doc_id"""


def _cut(expr: str) -> str:
    """Up to the end of the last token that a translation model takes; shorter texts whole."""
    most = fv.TRANSLATION_MAX_TOKENS
    head = f"regexp_extract({expr}, {_text(f'^(?:[{fv.WHITESPACE_CLASS}]*{_NOT_WS}){{{most}}}')})"
    return f"CASE WHEN len({_tokens(expr)}) > {most} THEN {head} ELSE {expr} END"


#: Aggregate over the turns of a chat: its template text.
_RENDERED_TURNS = f"""string_agg(concat({_text(fv.CHAT_TURN_START)}, role, chr(10), content,
    {_text(fv.CHAT_TURN_END)}, chr(10)), '' ORDER BY turn)"""


def _fitted(turns: str, key: str, tokens: int) -> str:
    """Turns (key, turn, role, content) with long contents cut to a level common to a key.

    In ascending order of length, a turn stays whole while it needs no more than its share
    of the room that the shorter ones left; the share of the first that needs more is
    the level. Shares only shrink from there on, so it is the largest of them.
    """
    tags = len(fv.CHAT_TURN_START + "\n" + fv.CHAT_TURN_END + "\n")
    return f"""
    SELECT {key}, turn, role,
           CASE WHEN length(content) > level THEN substring(content, 1, level::BIGINT) ELSE content END AS content
    FROM (
        SELECT *, max(CASE WHEN n * turns > room THEN room // turns END)
                      OVER (PARTITION BY {key}) AS level
        FROM (
            SELECT *, greatest({4 * tokens} - tags, 0) - shorter AS room, all_turns - place AS turns
            FROM (
                SELECT *, length(content) AS n,
                       sum({tags} + length(role)) OVER (PARTITION BY {key}) AS tags,
                       count(*) OVER (PARTITION BY {key}) AS all_turns,
                       row_number() OVER (PARTITION BY {key} ORDER BY length(content), turn) - 1 AS place,
                       coalesce(sum(length(content)) OVER (
                           PARTITION BY {key} ORDER BY length(content), turn
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS shorter
                FROM ({turns}))))"""


def _documents(change: str, name: str = "text") -> str:
    return f"SELECT doc_id, {change} AS {name} FROM documents"


def _pages(change: str) -> str:
    return f"SELECT page_id, {change} AS review_text FROM ({_MARKED_UP})"


_NORMALIZED = f"""
    SELECT *, cleaned_text AS before, {_normalized("cleaned_text")} AS after FROM ({_REVIEWS})"""

ORACLES: dict[str, str] = {
    "build_context": _contexts(),
    "build_context_hot": _contexts(),
    "build_context_forty": _contexts(_CURATED, fv.JOB_MAX_REVIEWS_PER_PLACE),
    "place_counts": f"""
        SELECT count(*) AS initial_places,
               count(*) FILTER (n >= {fv.MIN_REVIEWS_PER_PLACE}) AS kept_places,
               count(*) FILTER (n < {fv.MIN_REVIEWS_PER_PLACE}) AS removed_places
        FROM (SELECT count(*) AS n FROM ({_REVIEWS}) GROUP BY place_id)""",
    "approx_place_counts": f"""
        SELECT category, count(DISTINCT place_id) AS n_places, true AS close
        FROM (SELECT place_id, category FROM ({_REVIEWS})
              UNION ALL SELECT place_id, 'all' FROM ({_REVIEWS})) GROUP BY category""",
    "min_reviews_filter": f"""
        SELECT review_id, place_id, rating FROM ({_REVIEWS})
        QUALIFY count(*) OVER (PARTITION BY place_id) >= {fv.MIN_REVIEWS_PER_PLACE}""",
    "info_score": f"SELECT review_id, word_count, info_score FROM ({_scored(_REVIEWS)})",
    "rating_alloc": f"""
        SELECT place_id, rating, n_rating, n_rating / n_rated AS share,
               round_even(n_rating / n_rated * {fv.MAX_REVIEWS_PER_PLACE}, 0)::INTEGER AS alloc
        FROM (SELECT place_id, rating, count(*) AS n_rating,
                     sum(count(*)) OVER (PARTITION BY place_id) AS n_rated
              FROM ({_REVIEWS}) GROUP BY place_id, rating)""",
    "stratified_topk": f"""
        SELECT place_id, review_id, rating, word_count, info_score, rn, cleaned_text
        FROM ({_sampled(_REVIEWS, fv.MAX_REVIEWS_PER_PLACE)})""",
    "place_metadata": _metadata(_REVIEWS),
    "remove_nulls": f"""
        SELECT doc_id, review_text FROM (
            SELECT doc_id, {_strip('''CASE WHEN toxic = 1 THEN ' ' WHEN toxic = 0 THEN text END''')}
                   AS review_text
            FROM documents LEFT JOIN labels USING (doc_id))
        WHERE review_text <> ''""",
    "strip_html": _pages(_html("review_text")),
    "strip_urls": _pages(_urls("review_text")),
    "collapse_whitespace": _pages(_collapse("review_text")),
    "clean_text_basic": f"""
        SELECT page_id, {_clean("review_text")} AS review_text, review_text AS raw_text
        FROM ({_MARKED_UP})""",
    "detect_documents": f"""
        SELECT doc_id, lang, detected_lang
        FROM ({_detected("SELECT doc_id, lang, text FROM documents", "doc_id", "text")})""",
    "detect_conversations": f"""
        SELECT conv_id, turn, detected_lang FROM ({_detected(
            "SELECT conv_id, turn, text FROM conversations", "conv_id, turn", "text")})""",
    "language_allow_list": f"""
        SELECT review_id, detected_lang FROM ({_REVIEWS}) WHERE detected_lang IN ({_ALLOWED})""",
    "translation_flags": f"SELECT review_id, is_translated, cleaned_text FROM ({_FLAGGED})",
    "translate_with_backend": f"""
        SELECT review_id, is_translated,
               CASE WHEN detected_lang IN ({", ".join(map(_text, TRANSLATABLE))})
                    THEN concat('[', detected_lang, '>{TARGET}] ', cleaned_text)
                    ELSE cleaned_text END AS cleaned_text
        FROM ({_FLAGGED})""",
    "translate_truncated": f"""
        SELECT review_id, is_translated,
               CASE WHEN detected_lang IN ({", ".join(map(_text, TRANSLATABLE))})
                    THEN {_cut("concat('[', detected_lang, '>" + TARGET + "] ', " + _cut("cleaned_text") + ")")}
                    ELSE cleaned_text END AS cleaned_text
        FROM ({_FLAGGED})""",
    "translate_with_glossary": _GLOSSARY,
    "cleaned_pages": f"""
        SELECT page_id, review_text, raw_text, detected_lang,
               detected_lang <> '{TARGET}' AS is_translated, review_text AS cleaned_text
        FROM ({_detected(_PAGES_CLEAN, "page_id", "review_text")})
        WHERE detected_lang IN ({_ALLOWED})""",
    "resumable_clean": f"""
        SELECT review_id, place_id, rating, raw_text, detected_lang,
               detected_lang <> '{TARGET}' AS is_translated, review_text AS cleaned_text
        FROM ({_detected(_RAW_CLEAN, "review_id", "review_text")})
        WHERE detected_lang IN ({_ALLOWED})""",
    "norm_dot": _documents(_dots("text")),
    "norm_mash": _documents(_mash("text")),
    "norm_letter_runs": _documents(_letter_runs("text")),
    "norm_punct_runs": _documents(_punct_runs("text")),
    "norm_plural": _documents(_plural("text")),
    "norm_space_punct": _documents(_tight("text")),
    "normalize_full": _documents(_normalized("text")),
    "normalize_change_stats": f"""
        SELECT detected_lang, count(*) AS n_rows, count(*) FILTER (before <> after) AS n_changed
        FROM ({_NORMALIZED}) GROUP BY detected_lang""",
    "normalize_change_samples": f"""
        SELECT review_id, before, after FROM ({_NORMALIZED}) WHERE before <> after
        ORDER BY review_id LIMIT {fv.CHANGE_SAMPLE_ROWS}""",
    "char_entropy": _documents(f"round({_ENTROPY.format('text')}, 6)", "entropy"),
    "quality_reasons": f"SELECT review_id, reject_reason FROM ({_judged(_REVIEWS)})",
    "quality_filter": f"""
        SELECT review_id, cleaned_text FROM ({_judged(_REVIEWS)}) WHERE reject_reason IS NULL""",
    "quality_rejects": f"""
        SELECT review_id, cleaned_text, reject_reason FROM ({_judged(_REVIEWS)})
        WHERE reject_reason IS NOT NULL""",
    "quality_report": f"""
        SELECT coalesce(reject_reason, 'kept') AS outcome, count(*) AS n_rows
        FROM ({_judged(_REVIEWS)}) GROUP BY 1""",
    "curated_projection": f"""
        SELECT place_id, place_name, category, rating, detected_lang, cleaned_text
        FROM ({_REVIEWS})""",
    "curated_reviews": _CURATED,
    "pending_places": _PENDING,
    "daily_budget": f"SELECT * FROM ({_PENDING}) ORDER BY place_id LIMIT {DAILY_SHARE}",
    "enrich_extractive": _EXTRACTED,
    "enrich_with_backend": f"""
        SELECT place_id, place_name, llm_input_context AS input_context,
               md5(concat({_text(fv.SUMMARY_PROMPT)}, llm_input_context)) AS target_summary
        FROM ({_contexts()})""",
    "enrich_resumed": _EXTRACTED,
    "enrich_parts": f"""
        SELECT place_id, place_name, llm_input_context AS input_context,
               md5(concat({_text(fv.SUMMARY_PROMPT)}, llm_input_context)) AS target_summary,
               ceil(least(count(*) OVER (), {fv.DAILY_LIMIT}) / 4.0)::INTEGER AS parts
        FROM ({_contexts()}) QUALIFY row_number() OVER (ORDER BY place_id) <= {fv.DAILY_LIMIT}""",
    "enrich_after_failure": f"""
        SELECT place_id, md5(concat({_text(fv.SUMMARY_PROMPT)}, llm_input_context)) AS target_summary,
               concat('refused ', max(md5(llm_input_context)) OVER ()) AS first_error,
               count(*) OVER () AS n_summaries
        FROM ({_contexts()})""",
    "completed_keys": f"SELECT DISTINCT place_id FROM ({_REVIEWS})",
    "chat_messages_json": f"SELECT place_id, {_MESSAGES} AS messages FROM ({_ANSWERED})",
    "jsonl_roundtrip": f"SELECT text FROM ({_RENDERED})",
    "train_test_split": f"SELECT doc_id, lang, {_is_test('doc_id')} AS is_test FROM documents",
    "train_test_split_stable": f"""
        SELECT doc_id, lang,
               CAST(concat('0x', substring(md5(concat('{fv.SEED}:', doc_id)), 1, 8)) AS BIGINT)
                   < {int(fv.TEST_SIZE * 2**32)} AS is_test
        FROM documents""",
    "chat_files": f"""
        SELECT CASE WHEN {_is_test('place_id')} THEN 'test' ELSE 'train' END AS side,
               {_MESSAGES} AS messages
        FROM ({_ANSWERED})""",
    "chat_template_render": _RENDERED,
    "length_budget": f"""
        SELECT place_id, CAST(ceil(length(text) / 4.0) AS BIGINT) AS approx_tokens,
               ceil(length(text) / 4.0) <= 256 AS fits
        FROM ({_RENDERED})""",
    "length_budget_cut": f"""
        SELECT place_id, text, CAST(ceil(length(text) / 4.0) AS BIGINT) AS approx_tokens,
               ceil(length(text) / 4.0) <= 256 AS fits
        FROM (SELECT place_id, {_RENDERED_TURNS} AS text
              FROM ({_fitted(f"""
                  SELECT place_id, 0 AS turn, 'system' AS role, {_text(fv.CHAT_SYSTEM_PROMPT)} AS content
                  FROM ({_ANSWERED})
                  UNION ALL SELECT place_id, 1, 'user', concat({_text(fv.CHAT_USER_PREFIX)}, input_context)
                  FROM ({_ANSWERED})
                  UNION ALL SELECT place_id, 2, 'assistant', target_summary FROM ({_ANSWERED})""",
                  "place_id", 256)}) GROUP BY place_id)""",
    "conversations_cut": f"""
        SELECT conv_id, string_agg(length(content), ',' ORDER BY turn) AS lengths
        FROM ({_fitted("SELECT conv_id, turn, role, text AS content FROM conversations", "conv_id", 200)})
        GROUP BY conv_id""",
    "detect_by_slices": f"""
        SELECT doc_id, lang, detected_lang
        FROM ({_detected("SELECT doc_id, lang, text FROM documents", "doc_id", "text")})""",
    "clean_metrics": f"""
        WITH c AS (
            SELECT count(*) AS n_in, count(*) FILTER (detected_lang IN ({_ALLOWED})) AS n_out
            FROM ({_detected(_RAW_CLEAN, "review_id", "review_text")})),
        counts AS (SELECT (SELECT count(*) FROM documents) AS n_raw, n_in, n_out FROM c)
        SELECT run::INTEGER AS run, metric, value FROM (
            SELECT 'rows_in' AS metric, n_raw AS value FROM counts
            UNION ALL SELECT 'rows_out', n_out FROM counts
            UNION ALL SELECT 'removed_blank', n_raw - n_in FROM counts
            UNION ALL SELECT 'removed_language', n_in - n_out FROM counts),
            (SELECT unnest([1, 2]) AS run)""",
    "compacted_batches": """
        SELECT l_linenumber, count(*) AS n_rows, sum(l_quantity)::BIGINT AS quantity, 1 AS moved_files
        FROM lineitem GROUP BY l_linenumber""",
    "chat_template_conversations": f"""
        SELECT conv_id, string_agg(concat({_text(fv.CHAT_TURN_START)}, role, chr(10), text,
                                          {_text(fv.CHAT_TURN_END)}, chr(10)),
                                   '' ORDER BY turn, role, text) AS text
        FROM conversations GROUP BY conv_id""",
    "train_test_split_null_keys": """
        SELECT count(*) AS n_rows, count(*) FILTER (doc_id % 7 = 0) AS n_null_keys FROM documents""",
    "chat_files_repeated_keys": f"""
        SELECT messages FROM (SELECT {_MESSAGES} AS messages FROM (
            SELECT CASE WHEN place_id LIKE '%-0' THEN NULL ELSE 'one' END AS place_id,
                   input_context, target_summary FROM ({_ANSWERED})))""",
    "detector_accuracy": f"""
        SELECT lang, count(*) AS n_rows, count(*) FILTER (detected_lang = lang) AS n_right
        FROM ({_detected("SELECT doc_id, text, lang FROM documents WHERE doc_id % 5 = 0",
                         "doc_id", "text")}) GROUP BY lang""",
    "enrich_progress": f"""
        WITH c AS (SELECT count(*) AS n FROM ({_contexts()}))
        SELECT 1 AS run, least(n, {DAILY_SHARE}) AS tried, least(n, {DAILY_SHARE}) AS succeeded FROM c
        UNION ALL SELECT 2, n - least(n, {DAILY_SHARE}), n - least(n, {DAILY_SHARE}) FROM c
        UNION ALL SELECT 3, 0, 0""",
    "source_row_count": "SELECT count(*) AS n_rows FROM documents",
    "parquet_roundtrip": _REVIEWS,
    "stage_summary": f"""
        SELECT count(*) AS n_rows, count(*) FILTER (is_translated) AS n_translated
        FROM ({_FLAGGED})""",
    "stage_metrics": f"""
        SELECT 'normalize' AS stage, 'rows' AS metric, count(*) AS value FROM ({_REVIEWS})
        UNION ALL SELECT 'normalize', 'changed_rows', count(*)
            FROM ({_NORMALIZED}) WHERE before <> after
        UNION ALL SELECT 'quality', 'kept_rows', count(*) FROM ({_CURATED})
        UNION ALL SELECT 'quality', 'removed_rows',
            (SELECT count(*) FROM ({_REVIEWS})) - (SELECT count(*) FROM ({_CURATED}))""",
    "random_sample": f"""
        SELECT is_translated, cleaned_text FROM ({_FLAGGED})
        ORDER BY md5(concat('{fv.SEED}:', review_id)) LIMIT 10""",
    "random_place": f"""
        SELECT place_id, place_name, avg_rating, total_reviews_analyzed,
               substring(llm_input_context, 1, {fv.PREVIEW_CHARS}) AS preview
        FROM ({_contexts()}) ORDER BY md5(concat('{fv.SEED}:', place_id)) LIMIT 1""",
}
