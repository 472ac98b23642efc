"""DuckDB SQL stating what each registered query must return on the same tables."""

from __future__ import annotations

from twinline.sources import languages

WS = (
    "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) "
    "|| chr(133) || chr(160) || chr(5760) || chr(8192) || chr(8193) || chr(8194) || chr(8195) || chr(8196) "
    "|| chr(8197) || chr(8198) || chr(8199) || chr(8200) || chr(8201) || chr(8202) || chr(8232) || chr(8233) "
    "|| chr(8239) || chr(8287) || chr(12288)"
)

BASE = f"""
lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS ln
  FROM documents
),
raw AS (
  SELECT a.source, CAST(regexp_extract(a.source, '([0-9]+)$', 1) AS INTEGER) AS source_ord, a.doc_id,
         CAST((a.ln + 1) // 2 AS BIGINT) AS pair_no, a.line AS src, coalesce(b.line, '') AS tgt
  FROM lines a LEFT JOIN lines b ON a.doc_id = b.doc_id AND b.ln = a.ln + 1
  WHERE a.ln % 2 = 1
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, pair_no) AS line_no,
         count(*) OVER (PARTITION BY source) AS n_lines
  FROM raw
),
stripped AS (SELECT * REPLACE (trim(src, {WS}) AS src, trim(tgt, {WS}) AS tgt) FROM raw),
clean AS (SELECT * FROM stripped WHERE length(src) > 0 AND length(tgt) > 0),
marked AS (
  SELECT * REPLACE (
    CASE line_no % 7 WHEN 1 THEN '(' || src WHEN 2 THEN src || '"' WHEN 3 THEN '[' || src || ']'
      WHEN 4 THEN '“' || src WHEN 5 THEN string_split(src, ' ')[1] WHEN 6 THEN src || '?' ELSE src END AS src,
    CASE line_no % 7 WHEN 5 THEN string_split(tgt, ' ')[1] ELSE tgt END AS tgt)
  FROM numbered
),
marked_clean AS (
  SELECT * FROM (SELECT * REPLACE (trim(src, {WS}) AS src, trim(tgt, {WS}) AS tgt) FROM marked)
  WHERE length(src) > 0 AND length(tgt) > 0
)
"""
ROW = "source, doc_id, pair_no"


def _sql(select: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([BASE.strip(), *(c.strip() for c in ctes)]) + "\n" + select


def _kept(removed: str, table: str = "clean") -> str:
    return _sql(f"SELECT {ROW}, src, tgt FROM {table} WHERE NOT ({removed})")


def _either(condition: str) -> str:
    """A condition on ``{s}`` holding for either side."""
    return " OR ".join(f"({condition.format(s=side)})" for side in ("src", "tgt"))


def _differ(value: str) -> str:
    return f"{value.format(s='src')} <> {value.format(s='tgt')}"


def _without(char_class: str) -> str:
    """Length left after deleting everything outside a class."""
    return "length(regexp_replace({s}, '[^" + char_class + "]', '', 'g'))"


SYMBOLS = r"length(regexp_replace({s}, '[\p{{L}}\p{{N}} ]', '', 'g'))"
UPPERS = r"length(regexp_replace({s}, '[^\p{{Lu}}]', '', 'g'))"
DIGITS = "length(regexp_replace({s}, '[^0-9]', '', 'g'))"
LATIN = "length(regexp_replace({s}, '[^A-Za-z]', '', 'g'))"


def _count(ch: str) -> str:
    return "(length({s}) - length(replace({s}, '" + ch + "', '')))"


LETTER, CAPITAL = r"'^\p{L}'", r"'^\p{Lu}'"
FIRST_CHAR = f"""
CASE WHEN regexp_matches(src, {LETTER}) AND regexp_matches(tgt, {LETTER})
       THEN regexp_matches(src, {CAPITAL}) <> regexp_matches(tgt, {CAPITAL})
     WHEN regexp_matches(src, {LETTER}) OR regexp_matches(tgt, {LETTER}) THEN true
     ELSE src[1] <> tgt[1] END
"""

RATIO = "(CAST(length(src) AS DOUBLE) / CAST(length(tgt) AS DOUBLE))"


def _ratio(low: str, high: str) -> str:
    return f"({RATIO} <= CAST({low} AS DOUBLE) OR {RATIO} >= CAST({high} AS DOUBLE))"


def _share(count: str, limit: str) -> str:
    return _either(f"CAST({count} AS DOUBLE) / length({{s}}) >= CAST({limit} AS DOUBLE)")


FLAGSHIP_REMOVED = f"src = tgt OR {_ratio('0.2', '5')} OR length(src) <= 20 OR length(tgt) <= 20"
ADDED = f"added AS (SELECT * FROM clean WHERE NOT ({FLAGSHIP_REMOVED}))"
DISTINCT_PAIRS = f"""
{ADDED},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY src, tgt ORDER BY source_ord, doc_id, pair_no) AS nth,
         count(*) OVER (PARTITION BY src, tgt) AS copies
  FROM added
),
distinct_pairs AS (SELECT * FROM ranked WHERE nth = 1)
"""

FULL_REASON = f"""
CASE WHEN src = tgt THEN 'duplicates'
     WHEN {_either('length({s}) <= 5 OR length({s}) >= 2000')} THEN 'char_length'
     WHEN {_ratio('0.1', '10')} THEN 'source_target_ratio'
     WHEN {_either("contains({s}, 'http') OR contains({s}, '@')")} THEN 'contains'
     WHEN {_share(DIGITS, '0.2')} THEN 'digits_ratio'
     WHEN {FIRST_CHAR} THEN 'first_char_mismatch' END
"""


def _unpaired(side: str) -> str:
    """Drop odd quotes and uneven brackets of one side, as nested replacements."""
    expr = side
    for a, b in ("“”", "«»"):
        odd = f"(length({side}) - length(replace(replace({side}, '{a}', ''), '{b}', ''))) % 2 = 1"
        expr = f"CASE WHEN {odd} THEN replace(replace({expr}, '{a}', ''), '{b}', '') ELSE {expr} END"
    quotes = _count('"').format(s=side)
    expr = f"CASE WHEN {quotes} % 2 = 1 THEN regexp_replace({expr}, '\"', '') ELSE {expr} END"
    for a, b in ("[]", "()", "{}"):
        uneven = f"{_count(a).format(s=side)} <> {_count(b).format(s=side)}" if a != "{" else (
            f"(length({side}) - length(replace({side}, '{{', ''))) <> (length({side}) - length(replace({side}, '}}', '')))"
        )
        expr = f"CASE WHEN {uneven} THEN replace(replace({expr}, '{a}', ''), '{b}', '') ELSE {expr} END"
    return expr


CASED = f"""
CASE WHEN regexp_matches(src, {LETTER}) AND regexp_matches(tgt, {LETTER}) THEN
       CASE WHEN regexp_matches(src, {CAPITAL}) AND NOT regexp_matches(tgt, {CAPITAL})
              THEN upper(tgt[1]) || substr(tgt, 2)
            WHEN regexp_matches(src, '^\\p{{Ll}}') AND NOT regexp_matches(tgt, '^\\p{{Ll}}')
              THEN lower(tgt[1]) || substr(tgt, 2)
            ELSE tgt END
     ELSE tgt END
"""


def _removed(side: str, *pieces: str) -> str:
    for piece in pieces:
        side = f"replace({side}, '{piece}', '')"
    return side


ONE_WORD = "NOT contains(src, ' ') AND NOT contains(tgt, ' ')"
BARE = (
    r"regexp_matches(src, '[\p{L}\p{N}]$') AND right(src, 1) NOT IN ('?', '!', '.') "
    "AND right(tgt, 1) NOT IN ('?', '!', '.')"
)


def _augmented(table: str, punctuation: bool, low: bool, columns: str = "source, line_no") -> str:
    """Originals and augmented rows of a table, numbered in order per line."""
    parts = [f"SELECT {columns}, 0 AS place, CAST(NULL AS VARCHAR) AS aug, src, tgt FROM {table}"]
    if punctuation:
        for n, ch in enumerate("?!."):
            parts.append(
                f"SELECT {columns}, {1 + n}, 'single_word_punctuation', left(src, length(src) - 1), left(tgt, length(tgt) - 1) "
                f"FROM {table} WHERE {ONE_WORD} AND right(src, 1) = '{ch}' AND right(tgt, 1) = '{ch}'"
            )
            parts.append(
                f"SELECT {columns}, {4 + n}, 'single_word_punctuation', src || '{ch}', tgt || '{ch}' "
                f"FROM {table} WHERE {ONE_WORD} AND {BARE}"
            )
    if low:
        parts.append(
            f"SELECT {columns}, 7, 'lowercase', lower(src), lower(tgt) FROM {table} "
            "WHERE lower(src) <> src AND lower(tgt) <> tgt"
        )
    union = " UNION ALL ".join(parts)
    return (
        f"SELECT {columns}, row_number() OVER (PARTITION BY {columns} ORDER BY place) - 1 AS aug_ord, aug, src, tgt "
        f"FROM ({union})"
    )


VALIDATION = "CAST(trunc(least(5000.0::DOUBLE, count(*)::DOUBLE * 0.2::DOUBLE)) AS BIGINT)"
SPLIT = f"""
{DISTINCT_PAIRS},
keyed AS (SELECT *, md5(src || chr(9) || tgt || chr(9) || '0') AS key FROM distinct_pairs),
split AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY key) <= (SELECT {VALIDATION} FROM added)
                 THEN 'val' ELSE 'train' END AS split
  FROM keyed
)
"""

CONVERSATIONS = """
turns AS (
  SELECT 'conv' AS source, a.conv_id AS doc_id, a.turn AS pair_no, a.text AS src, b.text AS tgt
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
  WHERE a.role = 'user' AND b.role = 'assistant'
)
"""
CODE_LINES = """
code_lines AS (
  SELECT row_number() OVER (ORDER BY doc_id, pair_no) AS line_no, coalesce(nullif(string_split(src, ' ')[1], ''), '_') AS l,
         coalesce(nullif(string_split(tgt, ' ')[1], ''), '_') AS r
  FROM raw
)
"""

MIX = """
weights AS (SELECT DISTINCT source, source_ord, n_lines, 1 + source_ord % 5 AS w FROM numbered),
turns AS (
  SELECT n.*, (n.line_no - 1) // w.w AS round, w.w FROM numbered n JOIN weights w ON n.source = w.source
)
"""
MIXED = "SELECT row_number() OVER (ORDER BY round, source_ord, line_no) AS position, round, source, line_no, src, tgt FROM turns"

SENTENCES = """
sentences AS (
  SELECT source, doc_id, pair_no, 'src' AS side, src AS text FROM {t}
  UNION ALL SELECT source, doc_id, pair_no, 'tgt', tgt FROM {t}
)
"""
LINES = SENTENCES.format(t="clean")

NUMBERED_SENTENCES = """
sentences AS (
  SELECT source, line_no, 'src' AS side, src AS text FROM numbered
  UNION ALL SELECT source, line_no, 'tgt', tgt FROM numbered
)
"""

WORDS = """
words AS (SELECT unnest(regexp_split_to_array(text, '[ \\n]')) AS word FROM documents),
counts AS (SELECT word, count(*) AS freq FROM words WHERE word <> '' GROUP BY word)
"""

EVAL = """
eval_sets AS (
  SELECT 'devtest' AS split, 'en' AS lang, item_id + 1 AS line_no, replace(text, chr(10), ' ') AS text FROM benchmark
  UNION ALL SELECT 'devtest', 'it', item_id + 1, upper(replace(replace(text, chr(10), ' '), 'ß', 'ss')) FROM benchmark
)
"""

# Merges of the derived model, and words segmented by repeatedly joining their best-ranked neighbours.
# A symbol is written between chr(2) and chr(3), so joining is a plain replacement.
MERGES = """
bench_words AS (
  SELECT word, count(*) AS freq
  FROM (SELECT unnest(regexp_split_to_array(text, '[ \\n]')) AS word FROM benchmark) WHERE word <> '' GROUP BY word
),
steps AS (
  SELECT freq, left(word, i) AS l, CASE WHEN i = length(word) THEN '</w>' ELSE word[i + 1] END AS r
  FROM (SELECT word, freq, CAST(unnest(range(1, length(word) + 1)) AS INTEGER) AS i FROM bench_words)
),
weighed AS (SELECT l, r, sum(freq) AS weight FROM steps GROUP BY l, r),
merges AS (
  SELECT l, r, row_number() OVER (ORDER BY weight DESC, l, r) - 1 AS rank FROM weighed
  QUALIFY rank < 2000
)
"""
VOCABULARY = """
occurrences AS (
  SELECT source, doc_id, pair_no, side, unnest(string_split(text, ' ')) AS word,
         generate_subscripts(string_split(text, ' '), 1) AS n
  FROM sentences
),
vocabulary AS (SELECT DISTINCT word AS part FROM occurrences WHERE word <> '')
"""
SEGMENTS = """
joined AS (
  SELECT part, chr(2) || array_to_string(string_split(part, ''), chr(3) || chr(2)) || chr(3) || chr(2) || '</w>' || chr(3) AS symbols
  FROM vocabulary
  UNION ALL
  SELECT part, replace(symbols, chr(2) || best.l || chr(3) || chr(2) || best.r || chr(3), chr(2) || best.l || best.r || chr(3))
  FROM (
    SELECT p.part, p.symbols, min({'rank': m.rank, 'l': m.l, 'r': m.r}) AS best
    FROM (
      SELECT part, symbols, unnest(list_zip(syms[:-2], syms[2:])) AS pair
      FROM (SELECT part, symbols, string_split(symbols[2:-2], chr(3) || chr(2)) AS syms FROM joined)
    ) p JOIN merges m ON m.l = p.pair[1] AND m.r = p.pair[2]
    GROUP BY p.part, p.symbols
  )
),
finished AS (SELECT part, arg_min(symbols, length(symbols)) AS symbols FROM joined GROUP BY part),
segmented AS (
  SELECT part, list_filter(string_split(replace(symbols[2:-2], '</w>', ''), chr(3) || chr(2)), lambda s: s <> '') AS pieces
  FROM finished
)
"""
WHOLE_WORDS = "segments AS (SELECT part AS word, array_to_string(pieces, '@@ ') AS pieces FROM segmented)"
ENCODED = """
encoded AS (
  SELECT o.source, o.doc_id, o.pair_no, o.side, string_agg(s.pieces, ' ' ORDER BY o.n) AS encoded
  FROM occurrences o JOIN segments s ON o.word = s.word GROUP BY ALL
)
"""
# Words around glossary terms; the parts are segmented on their own, the terms stay whole.
GLOSSARY = """
occurrences AS (
  SELECT source, doc_id, pair_no, side, unnest(string_split(text, ' ')) AS word,
         generate_subscripts(string_split(text, ' '), 1) AS n
  FROM sentences
),
cut AS (
  SELECT word, unnest(parts) AS part, generate_subscripts(parts, 1) AS k
  FROM (SELECT word, list_filter(string_split(regexp_replace(word, '(tion|[0-9]+|(?:qu|th)e)', chr(1) || '\\1' || chr(1), 'g'), chr(1)),
                                 lambda s: s <> '') AS parts
        FROM (SELECT DISTINCT word FROM occurrences WHERE word <> ''))
),
vocabulary AS (SELECT DISTINCT part FROM cut WHERE NOT regexp_full_match(part, 'tion|[0-9]+|(?:qu|th)e'))
"""
AROUND_TERMS = """
segments AS (
  SELECT c.word, string_agg(coalesce(array_to_string(s.pieces, '@@ '), c.part), '@@ ' ORDER BY c.k) AS pieces
  FROM cut c LEFT JOIN segmented s ON c.part = s.part GROUP BY c.word
)
"""
# Pieces a vocabulary does not know fall apart into the pair they were merged from, again and again.
KNOWN = f"""
{WORDS.strip()},
known AS (
  SELECT token FROM (
    SELECT word AS token, freq FROM counts
    UNION ALL SELECT left(word, n) || '@@', freq FROM counts, (VALUES (1), (2), (3)) lengths(n) WHERE length(word) > n)
  GROUP BY token HAVING sum(freq) >= 20
)
"""
UNDONE = """
undone AS (
  SELECT part AS word, piece, k = len(pieces) AS final, lpad(CAST(k AS VARCHAR), 5, '0') AS path
  FROM (SELECT part, pieces, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS k FROM segmented)
  UNION ALL
  SELECT u.word, CASE WHEN half = 0 THEN m.l WHEN u.final THEN left(m.r, length(m.r) - 4) ELSE m.r END,
         u.final AND half = 1, u.path || half
  FROM undone u JOIN merges m ON m.l || m.r = u.piece || CASE WHEN u.final THEN '</w>' ELSE '' END,
       (VALUES (0), (1)) halves(half)
  WHERE NOT EXISTS (SELECT 1 FROM known WHERE token = u.piece || CASE WHEN u.final THEN '' ELSE '@@' END)
),
leaves AS (
  SELECT * FROM undone u
  WHERE NOT EXISTS (SELECT 1 FROM undone c WHERE c.word = u.word AND c.path = u.path || '0')
),
segments AS (SELECT word, string_agg(piece, '@@ ' ORDER BY path) AS pieces FROM leaves GROUP BY word)
"""


def _recursive(select: str, *ctes: str) -> str:
    return _sql(select, *ctes).replace("WITH ", "WITH RECURSIVE ", 1)


TOKENIZED = r"""
tokenized AS (
  SELECT id, which,
    list_filter(regexp_split_to_array(
      regexp_replace(regexp_replace(regexp_replace(regexp_replace(
        ' ' || replace(replace(replace(replace(replace(replace(replace(text,
          '<skipped>', ''), '-' || chr(10), ''), chr(10), ' '), '&quot;', '"'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>') || ' ',
        '([{-~\[-` -&(-+:-@/])', ' \1 ', 'g'),
        '([^0-9])([.,])', '\1 \2 ', 'g'),
        '([.,])([^0-9])', ' \1 \2', 'g'),
        '([0-9])(-)', '\1 \2 ', 'g'),
      '\s+'), lambda t: t <> '') AS toks
  FROM scored
),
grams AS (
  SELECT id, which, k.n AS n, array_to_string(toks[i:i + k.n - 1], ' ') AS gram
  FROM (SELECT id, which, toks, k.n AS n, unnest(range(1, len(toks) - k.n + 2)) AS i
        FROM tokenized, (VALUES (1), (2), (3), (4)) k(n)) g(id, which, toks, n, i),
       (SELECT 0) z, LATERAL (SELECT g.n AS n) k
),
gram_counts AS (
  SELECT id, n, gram, count(*) FILTER (WHERE which = 'h') AS h, count(*) FILTER (WHERE which = 'r') AS r
  FROM grams GROUP BY id, n, gram
),
sums AS (SELECT n, sum(least(h, r))::DOUBLE AS matched, sum(h)::DOUBLE AS total, sum(r)::DOUBLE AS ref_total FROM gram_counts GROUP BY n),
smoothed AS (
  SELECT *, CASE WHEN matched > 0 THEN matched / total
            ELSE 1 / (pow(2.0, count(*) FILTER (WHERE matched = 0) OVER (ORDER BY n)) * total) END AS precision
  FROM sums
),
bleu AS (
  SELECT round(CASE WHEN sum(matched) > 0 AND count(*) FILTER (WHERE total > 0) = 4 THEN
      100 * CASE WHEN max(total) FILTER (WHERE n = 1) < max(ref_total) FILTER (WHERE n = 1)
                 THEN exp(1 - max(ref_total) FILTER (WHERE n = 1) / max(total) FILTER (WHERE n = 1)) ELSE 1 END
      * exp(sum(ln(precision)) / 4) ELSE 0 END, 5) AS bleu,
    CAST(max(total) FILTER (WHERE n = 1) AS BIGINT) AS hyp_len,
    CAST(max(ref_total) FILTER (WHERE n = 1) AS BIGINT) AS ref_len
  FROM smoothed
)
"""

ORACLES: dict[str, str] = {
    "read_parallel": _sql(
        "SELECT row_number() OVER (ORDER BY source_ord, doc_id, pair_no) AS line_no, src, tgt FROM raw"
    ),
    "configured_corpora": _sql(
        f"""
        SELECT source, doc_id, pair_no, aug_ord, src, tgt FROM ({_augmented('s0', False, True, ROW)})
        UNION ALL
        SELECT {ROW}, 0, {_removed('src', '.', ',')}, {_removed('tgt', '.', ',')} FROM every
        WHERE source = 'src1' AND NOT (regexp_matches(src, '[1-9]') <> regexp_matches(tgt, '[1-9]'))
        UNION ALL
        SELECT {ROW}, 0, src, tgt FROM every WHERE source = 'src3' AND {LATIN.format(s='tgt')} <= 60
        UNION ALL
        SELECT {ROW}, 0, src, tgt FROM every WHERE source_ord >= 4
        """,
        f"every AS (SELECT * FROM clean WHERE NOT (src = tgt OR {_ratio('0.2', '5')}))",
        "s0 AS (SELECT * FROM every WHERE source = 'src0' AND length(src) > 20 AND length(tgt) > 20)",
    ),
    "language_map": f"""
        WITH docs AS (SELECT lang, count(*) AS documents FROM documents GROUP BY lang),
        listed(lang, code) AS (VALUES {", ".join(f"('{lang}', '{code}')" for lang, code in languages.codes().items())})
        SELECT coalesce(l.lang, d.lang) AS lang, coalesce(documents, 0) AS documents, code AS flores_code,
               string_split(code, '_')[1] AS iso3, string_split(code, '_')[2] AS script
        FROM listed l FULL JOIN docs d ON l.lang = d.lang""",
    "with_line_number": _sql("SELECT source, line_no, src, tgt FROM numbered"),
    "count_lines": _sql("SELECT source, count(*) AS lines FROM lines GROUP BY source UNION ALL SELECT 'none', 0"),
    "discover_corpora": """
        SELECT source AS folder, CASE WHEN even THEN 'Source.txt' ELSE 'corpus.en' END AS src_path,
               CASE WHEN even THEN 'target.txt' ELSE 'corpus.IT' END AS tgt_path, NOT even AS src_by_lang, NOT even AS tgt_by_lang
        FROM (SELECT DISTINCT source, CAST(right(source, 1) AS INTEGER) % 2 = 0 AS even FROM documents)""",
    "read_eval_set": f"WITH {EVAL.strip()} SELECT split, lang, line_no, text FROM eval_sets",
    "eval_pairs": f"""WITH {EVAL.strip()}
        SELECT a.line_no, a.text AS src, b.text AS tgt FROM eval_sets a JOIN eval_sets b ON a.line_no = b.line_no
        WHERE a.lang = 'en' AND b.lang = 'it'""",
    "write_parallel": _sql(
        "SELECT split, row_number() OVER (PARTITION BY split ORDER BY key) AS line_no, src, tgt FROM split", SPLIT
    ),
    "read_bpe_codes": _sql(
        "SELECT min(line_no) - 1 AS rank, l AS \"left\", r AS \"right\" FROM code_lines GROUP BY l, r",
        CODE_LINES,
    ),
    "read_bpe_codes_limited": _sql(
        "SELECT min(line_no) - 1 AS rank, l AS \"left\", r AS \"right\" FROM code_lines WHERE line_no <= 100 GROUP BY l, r", CODE_LINES
    ),
    "read_bpe_vocab": _sql("SELECT word AS token, freq FROM counts WHERE freq >= 10", WORDS),
    "resolve_corpus": """
        SELECT corpus, src_lang, tgt_lang, arg_min(url, page_id) AS url, count(*) AS matches
        FROM (SELECT page_id, url, regexp_extract(url, '^https?://([^/]+)/', 1) AS corpus, 'en' AS src_lang,
                     regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) AS tgt_lang FROM pages)
        GROUP BY corpus, src_lang, tgt_lang""",
    "swap_sides": _sql(f"SELECT {ROW}, tgt AS src, src AS tgt FROM raw"),
    "strip_pair": _sql(f"SELECT {ROW}, src, tgt FROM stripped"),
    "drop_empty": _sql(f"SELECT {ROW}, src, tgt FROM clean"),
    "duplicates": _kept("src = tgt"),
    "char_length": _kept(_either("length({s}) <= 20 OR length({s}) >= 500")),
    "source_target_ratio": _kept(_ratio("0.6", "1.5")),
    "uppercase_count_mismatch": _kept(_differ(UPPERS)),
    "contains": _kept(_either("contains({s}, 'http') OR contains({s}, '@')")),
    "digits_ratio": _kept(_share(DIGITS, "0.05")),
    "nonalphanum_ratio": _kept(_share(SYMBOLS, "0.1")),
    "digits_mismatch": _kept("regexp_matches(src, '[1-9]') <> regexp_matches(tgt, '[1-9]')"),
    "nonalphanum_count_mismatch": _kept(_differ(SYMBOLS)),
    "characters_count_mismatch": _kept(
        " OR ".join(_differ(_count(ch.replace("{", "{{").replace("}", "}}"))) for ch in '()[]?!:"“”{}'), "marked"
    ),
    "first_char_mismatch": _kept(FIRST_CHAR),
    "limit_latin_chars": _kept(f"{LATIN.format(s='src')} > 200"),
    "top": _sql(
        "SELECT source, line_no, src, tgt FROM numbered "
        "WHERE line_no <= CAST(trunc((30::DOUBLE / 100::DOUBLE) * n_lines::DOUBLE) AS BIGINT) + 1"
    ),
    "excerpt": _sql(
        "SELECT source, line_no, src, tgt FROM numbered "
        "WHERE line_no >= CAST(trunc((20::DOUBLE / 100::DOUBLE) * n_lines::DOUBLE) AS BIGINT) "
        "AND line_no <= CAST(trunc((60::DOUBLE / 100::DOUBLE) * n_lines::DOUBLE) AS BIGINT) + 1"
    ),
    "remove_unpaired_quotes_and_brackets": _sql(
        f"SELECT source, line_no, {_unpaired('src')} AS src, {_unpaired('tgt')} AS tgt FROM marked"
    ),
    "remove_chars": _sql(
        f"SELECT source, line_no, {_removed('src', 'ou', 'e', '.', '(')} AS src, "
        f"{_removed('tgt', 'ou', 'e', '.', '(')} AS tgt FROM marked"
    ),
    "first_case_normalize": _sql(f"SELECT source, line_no, src, {CASED} AS tgt FROM marked"),
    "recode_html_escape_chars": """
        SELECT page_id, regexp_replace(replace(replace(replace(html, '&middot;', '·'), '&copy;', '©'), '&quot;', '"'), '&amp;?', '&', 'g') AS src,
               url AS tgt FROM pages""",
    "single_word_punctuation": _sql(_augmented("marked_clean", True, False)),
    "lowercase": _sql(_augmented("marked_clean", False, True)),
    "filter_chain": _sql(f"SELECT {ROW}, {FULL_REASON} AS reason, src, tgt FROM clean"),
    "rejection_report": _sql(
        """SELECT source, reason, count(*) AS removed FROM judged WHERE reason IS NOT NULL
           GROUP BY GROUPING SETS ((source, reason), (source))""",
        f"judged AS (SELECT source, {FULL_REASON} AS reason FROM clean)",
    ),
    "transform_chain": _sql(
        f"SELECT source, line_no, src, {CASED} AS tgt FROM dropped",
        f"paired AS (SELECT source, line_no, {_unpaired('src')} AS src, {_unpaired('tgt')} AS tgt FROM marked)",
        f"dropped AS (SELECT source, line_no, {_removed('src', '*', '#', '%%')} AS src, {_removed('tgt', '*', '#', '%%')} AS tgt FROM paired)",
    ),
    "augment_fanout": _sql(_augmented("marked_clean", True, True)),
    "operator_registry": _kept(r"src = tgt OR regexp_matches(src, '\S{15,}') OR regexp_matches(tgt, '\S{15,}')"),
    "preprocess": _sql(
        _augmented("done", True, True),
        f"""kept AS (
            SELECT source, line_no, {_unpaired('src')} AS src, {_unpaired('tgt')} AS tgt FROM marked_clean
            WHERE line_no <= CAST(trunc((80::DOUBLE / 100::DOUBLE) * n_lines::DOUBLE) AS BIGINT) + 1
              AND src <> tgt AND length(src) > 2 AND length(tgt) > 2)""",
        f"done AS (SELECT source, line_no, src, {CASED} AS tgt FROM kept)",
    ),
    "merge_corpora": _sql(
        f"""SELECT {ROW}, src, tgt FROM clean WHERE source <> 'src7' AND NOT ({FLAGSHIP_REMOVED})
            UNION ALL SELECT {ROW}, src, tgt FROM conv WHERE length(src) > 30 AND length(tgt) > 30""",
        CONVERSATIONS,
        f"conv AS (SELECT source, doc_id, pair_no, trim(src, {WS}) AS src, trim(tgt, {WS}) AS tgt FROM turns)",
    ),
    "dedup_pairs": _sql(f"SELECT {ROW}, copies, src, tgt FROM distinct_pairs", DISTINCT_PAIRS),
    "merge_stats": _sql(
        """SELECT source, added, CAST(sum(added) OVER (ORDER BY source_ord) AS BIGINT) AS running_total,
                  n AS validation_size, CAST(sum(added) OVER () AS BIGINT) - n AS training_size
           FROM (SELECT source, source_ord, count(*) AS added FROM added GROUP BY ALL),
                (SELECT """ + VALIDATION + " AS n FROM added)",
        ADDED,
    ),
    "validation_size": _sql(f"SELECT count(*) AS total, {VALIDATION} AS validation_size FROM added", ADDED),
    "train_val_split": _sql(f"SELECT {ROW}, split, src, tgt FROM split", SPLIT),
    "shuffle_corpus": _sql(
        f"SELECT {ROW}, row_number() OVER (ORDER BY md5(src || chr(9) || tgt || chr(9) || '1')) AS position, src, tgt FROM distinct_pairs",
        DISTINCT_PAIRS,
    ),
    "source_fingerprint": "SELECT md5(string_agg(source, '|' ORDER BY source)) AS fingerprint FROM (SELECT DISTINCT source FROM documents)",
    "sources_changed": """
        SELECT a.f AS fingerprint, b.f AS stored, a.f <> b.f AS changed
        FROM (SELECT md5(string_agg(source, '|' ORDER BY source)) AS f FROM (SELECT DISTINCT source FROM documents)) a,
             (SELECT md5(string_agg(source, '|' ORDER BY source)) AS f
              FROM (SELECT DISTINCT d.source FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.toxic = 1)) b""",
    "weighted_mix": _sql(MIXED, MIX),
    "weighted_mix_first_exhausted": _sql(
        MIXED + """ WHERE (round, source_ord) <= (SELECT (n_lines // w, source_ord) FROM weights ORDER BY n_lines // w, source_ord LIMIT 1)""",
        MIX,
    ),
    "training_sample": _sql(
        """SELECT * FROM sentences QUALIFY row_number() OVER (ORDER BY
           md5(side || chr(9) || source || chr(9) || doc_id || chr(9) || pair_no || chr(9) || '3')) <= 1000""",
        SPLIT,
        CONVERSATIONS,
        f"""drawn AS (
            SELECT {ROW}, src, tgt FROM split WHERE split = 'train' UNION ALL SELECT {ROW}, src, tgt FROM turns)""",
        SENTENCES.format(t="drawn"),
    ),
    "max_tokens": _sql(
        f"""SELECT {ROW}, src, tgt FROM clean
            WHERE len(list_filter(string_split(src, ' '), lambda t: t <> '')) BETWEEN 1 AND 40
              AND len(list_filter(string_split(tgt, ' '), lambda t: t <> '')) BETWEEN 1 AND 60"""
    ),
    "find_text": _sql("SELECT * FROM sentences WHERE contains(lower(text), 'tion ou')", NUMBERED_SENTENCES),
    "find_text_exact": _sql(
        f"SELECT * FROM sentences WHERE trim(lower(text), {WS}) = 'in in oredble ea.'", NUMBERED_SENTENCES
    ),
    "bpe_encode": _recursive("SELECT * FROM encoded", LINES, MERGES, VOCABULARY, SEGMENTS, WHOLE_WORDS, ENCODED),
    "bpe_encode_line": _recursive(
        "SELECT * REPLACE ('  ' || encoded || ' ' || chr(13) AS encoded) FROM encoded",
        LINES, MERGES, VOCABULARY, SEGMENTS, WHOLE_WORDS, ENCODED,
    ),
    "bpe_encode_vocab": _recursive(
        "SELECT * FROM encoded", LINES, MERGES, KNOWN, VOCABULARY, SEGMENTS, UNDONE, ENCODED
    ),
    "bpe_encode_glossaries": _recursive(
        "SELECT * FROM encoded", LINES, MERGES, GLOSSARY, SEGMENTS, AROUND_TERMS, ENCODED
    ),
    "bpe_decode": _sql(
        f"""SELECT {ROW}, side, array_to_string(list_filter(string_split(text, ' '), lambda t: t <> ''), ' ') AS decoded
            FROM sentences""",
        LINES,
    ),
    "sp_decode": _sql(f"SELECT {ROW}, side, text AS decoded FROM sentences", LINES),
    "vocab_to_counts": _sql(
        """SELECT word AS token, CAST(floor(exp(logprob) * 1000000) AS BIGINT) + 1 AS freq FROM (
             SELECT word, freq, CAST(CAST(ln(CAST(freq AS DOUBLE) / (SELECT sum(freq) FROM counts)) AS DECIMAL(12, 4)) AS DOUBLE) AS logprob
             FROM counts)
           WHERE freq NOT IN (7, 8) AND word NOT IN ('<unk>', '<s>', '</s>')""",
        WORDS,
    ),
    "corpus_bleu": _sql(
        "SELECT * FROM bleu",
        """scored AS (
             SELECT doc_id * 16777216 + pair_no AS id, 'h' AS which, src AS text FROM raw
             UNION ALL SELECT doc_id * 16777216 + pair_no, 'r', tgt FROM raw)""",
        TOKENIZED,
    ),
    "sentence_lookup": f"""WITH {EVAL.strip()},
        chosen AS (SELECT line_no, text AS ref, replace(text, ' the', '') AS hyp FROM eval_sets WHERE lang = 'en' AND line_no = 4),
        scored AS (SELECT line_no AS id, 'h' AS which, hyp AS text FROM chosen UNION ALL SELECT line_no, 'r', ref FROM chosen),
        {TOKENIZED.strip()}
        SELECT line_no, ref, hyp, bleu FROM chosen, bleu""",
    "write_hypotheses": _sql("SELECT row_number() OVER (ORDER BY doc_id, pair_no) AS line_no, src AS line FROM raw"),
}
