"""SQL counterparts of the queries, written for DuckDB.

The statements share common table expressions: ``prepared`` for cleaned texts,
``sides`` for the split, ``feat`` for TF-IDF, ``theta`` and ``scored`` for naive
Bayes. Each statement is spelt out from the semantics, not from the Spark plans.
"""

from __future__ import annotations

STRIP = (
    r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
TOKEN = r"[\x{0900}-\x{097F}\p{L}\p{N}_]+"
BROWSER = r"\x{09}-\x{0d}\x{20}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}"


def _decode(x: str) -> str:
    """The character references that occur in the tables; their semicolon may be
    missing, as HTML allows for these names. The ampersand comes last."""
    for name, char in (("middot", "·"), ("copy", "©"), ("quot", '"'), ("amp", "&")):
        x = f"regexp_replace({x}, '&{name};?', '{char}', 'g')"
    return x


def _clean(x: str, lowercase: bool = True, entities: bool = False) -> str:
    x = f"coalesce({x}, '')"
    if entities:
        x = _decode(x)
    x = f"nfc_normalize({x})"
    pairs = [(0xA0, " "), (0x201C, '"'), (0x201D, '"'), (0x2018, "'"), (0x2019, "'"), (0x60, "'")]
    pairs += [(0xAB, '"'), (0xBB, '"'), (0x2013, "-"), (0x2014, "-"), (0x2015, "-"), (0x2212, "-")]
    old = "".join(chr(c) for c, _ in pairs) + "\ufeff\u200b\u200e\u200f"
    new = "".join(n for _, n in pairs).replace("'", "''")
    x = f"translate({x}, '{old}', '{new}')"
    if lowercase:
        x = f"lower({x})"
    x = rf"regexp_replace({x}, '[ \t\r\n]+', ' ', 'g')"
    return f"regexp_replace({x}, '^[{STRIP}]+|[{STRIP}]+$', '', 'g')"


def _words(x: str) -> str:
    return f"regexp_extract_all({x}, '{TOKEN}')"


def _grams(words: str, high: int) -> str:
    """All 1- to ``high``-grams of a list of words."""
    parts = words
    for n in range(2, high + 1):
        run = " || ' ' || ".join(f"{words}[i + {k}]" if k else f"{words}[i]" for k in range(n))
        parts = f"list_concat({parts}, list_transform(range(1, len({words}) - {n - 2}), lambda i: {run}))"
    return parts


DOCUMENTS = """corpus AS (
  SELECT doc_id AS "ID", text AS "Text", lang AS "Label", source AS "Original_Label" FROM documents)"""
TURNS = """corpus AS (
  SELECT conv_id * 1000000 + turn AS "ID", text AS "Text", role AS "Label", conv_id, turn FROM conversations)"""
PREPARED = f"""prepared AS (SELECT *, {_clean('"Text"')} AS "Cleaned_Text" FROM corpus)"""
QUOTA = """class_n AS (SELECT "Label", count(*) AS n FROM corpus GROUP BY 1),
drawn AS (SELECT sum(n) AS total, ceil(sum(n) * 0.2)::BIGINT AS draws FROM class_n),
floors AS (
  SELECT "Label", n, (draws * n // total)::BIGINT AS base, (draws * n % total)::BIGINT AS rest, draws
  FROM class_n, drawn),
quota AS (
  SELECT "Label", n,
    base + CASE WHEN row_number() OVER (ORDER BY rest DESC, "Label") <= draws - sum(base) OVER () THEN 1 ELSE 0 END AS n_test
  FROM floors)"""
SIDES = """sides AS (
  SELECT p.*, CASE WHEN row_number() OVER (PARTITION BY "Label" ORDER BY md5('42:' || "ID"), "ID") <= n_test
    THEN 'test' ELSE 'train' END AS split
  FROM prepared p JOIN quota USING ("Label"))"""
SPLIT = f"{QUOTA},\n{SIDES}"


def _tfidf(high: int = 2, keep: str = "df >= 2", tf: str = "1 + ln(tf)", idf: str = "ln((1 + n) / (1 + df)) + 1") -> str:
    return f"""tokenised AS (SELECT "ID", "Label", split, {_words('"Cleaned_Text"')} AS w FROM sides),
grams AS (SELECT "ID", "Label", split, unnest({_grams('w', high)}) AS term FROM tokenised),
tf AS (SELECT "ID", "Label", split, term, count(*) AS tf FROM grams GROUP BY ALL),
nd AS (SELECT count(*)::DOUBLE AS n FROM sides WHERE split = 'train'),
stat AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS tf FROM tf WHERE split = 'train' GROUP BY term),
vocab AS (SELECT term, df, tf, {idf} AS idf FROM stat, nd WHERE {keep}),
raw AS (
  SELECT t."ID", t."Label", t.split, t.term, t.tf, ({tf.replace('tf', 't.tf')}) * v.idf AS raw
  FROM tf t JOIN vocab v ON v.term = t.term),
feat AS (SELECT *, raw / sqrt(sum(raw * raw) OVER (PARTITION BY "ID")) AS tfidf FROM raw)"""


THETA = """sct AS (SELECT "Label", term, sum(tfidf) AS s FROM feat WHERE split = 'train' GROUP BY 1, 2),
tot AS (SELECT "Label", sum(s) AS tot FROM sct GROUP BY 1),
size AS (SELECT count(*) AS v FROM vocab),
theta AS (
  SELECT t."Label" AS label, vocab.term, ln((coalesce(s, 0) + 1) / (tot + v)) AS w
  FROM tot t CROSS JOIN vocab CROSS JOIN size LEFT JOIN sct ON sct.term = vocab.term AND sct."Label" = t."Label"),
prior AS (SELECT "Label" AS label, ln(count(*) / n) AS lp FROM sides, nd WHERE split = 'train' GROUP BY "Label", n)"""
SCORED = """sums AS (
  SELECT f."ID", t.label, sum(f.tfidf * t.w) AS s FROM feat f JOIN theta t ON t.term = f.term GROUP BY 1, 2),
present AS (SELECT "ID", count(*) AS features FROM feat GROUP BY 1),
z AS (
  SELECT d."ID", d."Label", d.split, p.label AS cls, p.lp + coalesce(s.s, 0) AS z
  FROM sides d CROSS JOIN prior p LEFT JOIN sums s ON s."ID" = d."ID" AND s.label = p.label),
e AS (SELECT *, exp(z - max(z) OVER (PARTITION BY "ID")) AS e FROM z),
prob AS (SELECT *, e / sum(e) OVER (PARTITION BY "ID") AS p FROM e),
ranked AS (SELECT *, row_number() OVER (PARTITION BY "ID" ORDER BY p DESC, cls) AS rank FROM prob),
scored AS (
  SELECT r."ID", r."Label", r.split, r.cls AS predicted_label, r.p, coalesce(f.features, 0) AS features
  FROM ranked r LEFT JOIN present f ON f."ID" = r."ID" WHERE rank = 1)"""
COUNTS = """counts AS (
  SELECT "Label" AS actual, predicted_label AS predicted, count(*) AS n FROM scored WHERE split = 'test' GROUP BY 1, 2)"""


def _labels(*names: str) -> str:
    return "labels AS (SELECT * FROM (VALUES " + ", ".join(f"('{n}')" for n in names) + ") v(label))"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


BAYES_DOCUMENTS = (DOCUMENTS, PREPARED, SPLIT, _tfidf(), THETA, SCORED)
BAYES_TURNS = (TURNS, PREPARED, SPLIT, _tfidf(), THETA, SCORED)

REPORT = """report AS (
  SELECT l.label,
    coalesce(tp / nullif(called, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall,
    coalesce(2 * tp / nullif(called + support, 0), 0) AS f1, support
  FROM (
    SELECT l.label,
      coalesce(sum(n) FILTER (actual = l.label AND predicted = l.label), 0)::DOUBLE AS tp,
      coalesce(sum(n) FILTER (actual = l.label), 0)::BIGINT AS support,
      coalesce(sum(n) FILTER (predicted = l.label), 0)::BIGINT AS called
    FROM labels l LEFT JOIN counts ON true GROUP BY 1) l)"""
REPORT_ROWS = """SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM report"""
OVERALL = """overall AS (
  SELECT (SELECT sum(n) FILTER (actual = predicted) / sum(n) FROM counts) AS "Accuracy",
    avg(precision) AS "Macro_Precision", avg(recall) AS "Macro_Recall", avg(f1) AS "Macro_F1",
    sum(precision * support) / sum(support) AS "Weighted_Precision",
    sum(recall * support) / sum(support) AS "Weighted_Recall",
    sum(f1 * support) / sum(support) AS "Weighted_F1"
  FROM report)"""
ROUNDED_OVERALL = ", ".join(
    f'round("{m}", 6) AS "{m}"'
    for m in ("Accuracy", *(f"{kind}_{m}" for kind in ("Macro", "Weighted") for m in ("Precision", "Recall", "F1")))
)
ROLES = _labels("user", "assistant", "system")
ROLES_AND_ABSENT = _labels("user", "assistant", "system", "tool")
CELLS = """cells AS (
  SELECT a.label AS actual, p.label AS predicted, coalesce(n, 0)::BIGINT AS n
  FROM labels a CROSS JOIN labels p LEFT JOIN counts c ON c.actual = a.label AND c.predicted = p.label)"""
EXPLAINED = """contributions AS (
  SELECT f."ID", s.predicted_label, s.features, f.term, f.tfidf, t.w, round(f.tfidf * t.w, 4) AS contribution,
    f.tfidf * t.w >= 0 AS is_positive
  FROM feat f JOIN scored s ON s."ID" = f."ID" JOIN theta t ON t.term = f.term AND t.label = s.predicted_label
  WHERE s.split = 'test')"""
PCT = "printf('%.2f%%', {} * 100)"
ERRORS = "errors AS (SELECT *, round(p, 4) AS confidence FROM scored WHERE split = 'test' AND \"Label\" <> predicted_label)"

DUPLICATES = """SELECT '{column}' AS column_name, count(*) AS n_groups, coalesce(sum(n), 0)::BIGINT AS n_rows,
  coalesce(sum(n - 1), 0)::BIGINT AS n_surplus
FROM (SELECT count(*) AS n FROM {table} GROUP BY {key} HAVING count(*) > 1)"""
OVERLAP = """SELECT count(*) FILTER (tr) AS n_train_texts, count(*) FILTER (te) AS n_test_texts, count(*) FILTER (tr AND te) AS n_overlap
FROM (SELECT bool_or(split = 'train') AS tr, bool_or(split = 'test') AS te FROM {table} GROUP BY "Cleaned_Text")"""
GROUPED = """texts AS (SELECT sha256("Cleaned_Text") AS "ID", min("Label") AS "Label" FROM every_text GROUP BY 1),
corpus AS (SELECT * FROM texts), prepared AS (SELECT * FROM texts)"""
EVERY_TEXT = f"""every_text AS (
  SELECT doc_id, lang AS "Label", {_clean('text')} AS "Cleaned_Text" FROM documents)"""
GROUP_ROWS = """grouped AS (
  SELECT t.doc_id, t."Cleaned_Text", s.split FROM every_text t JOIN sides s ON s."ID" = sha256(t."Cleaned_Text"))"""

ORACLE_SQL = {
    # Text
    "clean_text": _with(DOCUMENTS, PREPARED) + 'SELECT "ID", "Cleaned_Text" FROM prepared',
    "clean_pages": f"SELECT page_id, {_clean('html', entities=True)} AS cleaned_html FROM pages",
    "html_unescape": f"SELECT page_id, {_decode('html')} AS decoded FROM pages",
    "clean_keep_case": f"SELECT item_id, {_clean('text', lowercase=False)} AS cleaned FROM benchmark",
    "clean_change_rate": _with(DOCUMENTS, PREPARED)
    + """SELECT count(*) AS n_rows, count(*) FILTER (coalesce("Text", '') <> "Cleaned_Text") AS n_changed,
  count(*) FILTER ("Cleaned_Text" = '') AS n_empty,
  round(avg(CASE WHEN coalesce("Text", '') <> "Cleaned_Text" THEN 1 ELSE 0 END) * 100, 4) AS changed_pct FROM prepared""",
    "empty_after_cleaning": _with(DOCUMENTS, PREPARED)
    + """SELECT count(*) AS n_empty FROM prepared WHERE "Cleaned_Text" = ''""",
    "tokenize_counts": _with(DOCUMENTS, PREPARED)
    + f"""SELECT "ID", len(w)::BIGINT AS n_tokens, len(list_distinct(w))::BIGINT AS n_distinct,
  md5(array_to_string(w, ' ')) AS tokens_md5
FROM (SELECT "ID", {_words('"Cleaned_Text"')} AS w FROM prepared)""",
    "ngram_counts": _with(TURNS, PREPARED, f"""words AS (SELECT {_words('"Cleaned_Text"')} AS w FROM prepared)""")
    + f"SELECT term, count(*) AS n FROM (SELECT unnest({_grams('w', 3)}) AS term FROM words) GROUP BY term",
    "text_profile": rf"""WITH c AS (
  SELECT doc_id, text, len(regexp_extract_all(text, '[\x{{0900}}-\x{{097F}}]')) AS dev,
    len(regexp_extract_all(text, '[A-Za-z]')) AS lat FROM documents)
SELECT doc_id AS "ID", len(regexp_extract_all(text, '[^{BROWSER}]+'))::BIGINT AS words,
  (length(text) + len(regexp_extract_all(text, '[\x{{10000}}-\x{{10FFFF}}]')))::BIGINT AS chars,
  coalesce(floor(dev / nullif(dev + lat, 0) * 100 + 0.5), 0)::BIGINT AS devanagari_pct,
  coalesce(floor(lat / nullif(dev + lat, 0) * 100 + 0.5), 0)::BIGINT AS latin_pct,
  len(regexp_extract_all(text, '[0-9\x{{0966}}-\x{{096F}}]'))::BIGINT AS digits
FROM c""",
    "script_flags": _with(DOCUMENTS, PREPARED)
    + r"""SELECT count(*) FILTER (dev) AS n_devanagari, count(*) FILTER (lat) AS n_latin,
  count(*) FILTER (dev AND lat) AS n_code_mixed, count(*) FILTER (dig) AS n_with_digits
FROM (SELECT regexp_matches("Cleaned_Text", '[\x{0900}-\x{097F}]') AS dev, regexp_matches("Cleaned_Text", '[A-Za-z]') AS lat,
  regexp_matches("Cleaned_Text", '[0-9\x{0966}-\x{096F}]') AS dig FROM prepared)""",
    "validate_rows": _with(DOCUMENTS, PREPARED)
    + f"""SELECT CASE WHEN "Text" IS NULL THEN 'input is null'
  WHEN regexp_full_match("Text", '[{STRIP}]*') THEN 'input is blank'
  WHEN "Cleaned_Text" = '' THEN 'input has no readable text' ELSE 'ok' END AS outcome, count(*) AS n
FROM prepared GROUP BY 1""",
    "word_count": f"""SELECT doc_id AS "ID", len(regexp_extract_all(text, '[^{STRIP}]+'))::BIGINT AS n_words FROM documents""",
    # Audits and statistics
    "null_audit": _with(DOCUMENTS)
    + "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER ("{c}" IS NULL) AS n_null FROM corpus"""
        for c in ("ID", "Text", "Label", "Original_Label")
    ),
    "row_count_check": "SELECT count(*) AS n_rows, 1000::BIGINT AS expected, count(*) = 1000 AS passed FROM documents",
    "label_domain": _with(DOCUMENTS, _labels("en", "fr", "de", "mr"))
    + """SELECT coalesce(l.label, f."Label") AS label, coalesce(n, 0)::BIGINT AS n,
  CASE WHEN n IS NULL THEN 'missing' WHEN l.label IS NULL THEN 'unexpected' ELSE 'ok' END AS status
FROM labels l FULL JOIN (SELECT "Label", count(*) AS n FROM corpus GROUP BY 1) f ON f."Label" = l.label""",
    "duplicate_ids": DUPLICATES.format(column="ID", table="conversations", key="conv_id"),
    "duplicate_texts": """SELECT "ID", copies FROM (SELECT doc_id AS "ID", count(*) OVER (PARTITION BY text) AS copies FROM documents)
WHERE copies > 1""",
    "duplicate_cleaned": _with(DOCUMENTS, PREPARED)
    + DUPLICATES.format(column="Cleaned_Text", table="prepared", key='"Cleaned_Text"'),
    "label_conflicts": _with(DOCUMENTS, PREPARED)
    + """SELECT sha256("Cleaned_Text") AS text_digest, count(DISTINCT "Original_Label") AS n_labels, count(*) AS n_rows
FROM prepared GROUP BY 1 HAVING count(DISTINCT "Original_Label") > 1""",
    "integrity_report": _with(DOCUMENTS, PREPARED, _labels("en", "fr", "de", "es"))
    + """, found AS (SELECT DISTINCT "Label" FROM prepared),
facts AS (
  SELECT 'null_values' AS "check", (SELECT count(*) FROM prepared WHERE "ID" IS NULL) + (SELECT count(*) FROM prepared WHERE "Text" IS NULL)
    + (SELECT count(*) FROM prepared WHERE "Label" IS NULL) + (SELECT count(*) FROM prepared WHERE "Original_Label" IS NULL) AS value, true AS blocking
  UNION ALL SELECT 'labels_off_domain', (SELECT count(*) FROM labels FULL JOIN found ON found."Label" = labels.label WHERE labels.label IS NULL OR found."Label" IS NULL), true
  UNION ALL SELECT 'duplicate_ID', (SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM prepared GROUP BY "ID" HAVING count(*) > 1)), true
  UNION ALL SELECT 'duplicate_Text', (SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM prepared GROUP BY "Text" HAVING count(*) > 1)), false
  UNION ALL SELECT 'duplicate_Cleaned_Text', (SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM prepared GROUP BY "Cleaned_Text" HAVING count(*) > 1)), false
  UNION ALL SELECT 'conflicting_labels', (SELECT count(*) FROM (SELECT 1 FROM prepared GROUP BY "Cleaned_Text" HAVING count(DISTINCT "Label") > 1)), true)
SELECT "check", value::BIGINT AS value, value = 0 OR NOT blocking AS passed FROM facts""",
    "class_distribution": "SELECT lang AS label, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM documents GROUP BY 1",
    "corpus_stats": _with(DOCUMENTS, PREPARED, SPLIT)
    + """SELECT "Label" AS label, count(*) AS n, round(count(*) / sum(count(*)) OVER () * 100, 2) AS pct,
  (sum(count(*)) OVER ())::BIGINT AS total_records, count(*) OVER () AS total_categories,
  (sum(count(*) FILTER (split = 'train')) OVER ())::BIGINT AS train_records,
  (sum(count(*) FILTER (split = 'test')) OVER ())::BIGINT AS test_records
FROM sides GROUP BY 1""",
    "category_profile": f"""SELECT lang AS label, count(*) AS record_count, round(count(*) / sum(count(*)) OVER () * 100, 2) AS percentage,
  round(avg(len(regexp_extract_all(text, '[^{STRIP}]+'))), 1) AS avg_words
FROM documents GROUP BY 1""",
    "category_samples": """SELECT lang AS "Label", sample_rank::INTEGER AS sample_rank, doc_id AS "ID"
FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) AS sample_rank FROM documents)
WHERE sample_rank <= 5""",
    "category_filter": """SELECT doc_id AS "ID", lang AS "Label" FROM documents WHERE lower(lang) = 'fr'""",
    "category_check": """SELECT 'FR' AS category, count(*) AS n, count(*) > 0 AS known FROM documents WHERE lower(lang) = 'fr'
UNION ALL SELECT 'Sports', count(*), count(*) > 0 FROM documents WHERE lower(lang) = 'sports'""",
    "random_sample": """SELECT doc_id AS "ID", lang AS "Label" FROM documents WHERE lang = 'en'
ORDER BY md5('42:' || doc_id), doc_id LIMIT 10""",
    # Splits
    "split_any_ids": _with(
        """corpus AS (
  SELECT CASE WHEN turn % 3 <> 0 THEN conv_id END AS "ID", role AS "Label",
    CASE WHEN turn = 0 THEN 'one text of many copies' ELSE text END AS "Text" FROM conversations)""",
        QUOTA,
    )
    + """SELECT "ID", "Label", text_digest, split, count(*) AS n FROM (
  SELECT "ID", c."Label", md5("Text") AS text_digest, CASE WHEN row_number() OVER (PARTITION BY c."Label"
    ORDER BY md5('42:' || coalesce("ID"::VARCHAR, '')), md5("Text")) <= n_test THEN 'test' ELSE 'train' END AS split
  FROM corpus c JOIN quota q ON q."Label" = c."Label") GROUP BY ALL""",
    "split_quota": _with(DOCUMENTS, QUOTA)
    + """SELECT "Label" AS label, n, (n - n_test)::BIGINT AS n_train, n_test::BIGINT AS n_test FROM quota""",
    "stratified_split": _with(DOCUMENTS, PREPARED, SPLIT) + 'SELECT "ID", "Label", split FROM sides',
    "split_distribution": _with(DOCUMENTS, PREPARED, SPLIT)
    + """SELECT label, total, train, test, round(train * 100 / sum(train) OVER (), 4) AS train_pct, round(test * 100 / sum(test) OVER (), 4) AS test_pct
FROM (SELECT "Label" AS label, count(*) AS total, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'test') AS test
  FROM sides GROUP BY 1)""",
    "prepare_corpus": _with(DOCUMENTS, PREPARED, SPLIT)
    + """SELECT label, total, train, test, round(train * 100 / sum(train) OVER (), 4) AS train_pct, round(test * 100 / sum(test) OVER (), 4) AS test_pct
FROM (SELECT "Label" AS label, count(*) AS total, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'test') AS test
  FROM sides GROUP BY 1)""",
    "split_overlap": _with(DOCUMENTS, PREPARED, SPLIT) + OVERLAP.format(table="sides"),
    "group_split": _with(EVERY_TEXT, GROUPED, SPLIT, GROUP_ROWS) + 'SELECT doc_id AS "ID", split FROM grouped',
    "group_split_overlap": _with(EVERY_TEXT, GROUPED, SPLIT, GROUP_ROWS) + OVERLAP.format(table="grouped"),
    "split_tables": _with(DOCUMENTS, PREPARED, SPLIT)
    + """SELECT split, count(*) AS expected_rows, count(*) AS written_rows, true AS columns_match, true AS rows_match FROM sides GROUP BY 1""",
    "split_scan": _with(DOCUMENTS, PREPARED, SPLIT) + 'SELECT "ID", "Cleaned_Text", "Label", split FROM sides',
    **dict.fromkeys(("csv_roundtrip", "csv_quoted"), _with(DOCUMENTS) + "SELECT * FROM corpus"),
    # Features
    "vocab_df": _with(DOCUMENTS, PREPARED, SPLIT, _tfidf())
    + "SELECT term, (row_number() OVER (ORDER BY term) - 1)::BIGINT AS idx, df, tf, round(idf, 6) AS idf FROM vocab",
    **dict.fromkeys(
        ("vocab_merged", "vocab_subtracted"),
        _with(DOCUMENTS, PREPARED, SPLIT, _tfidf())
        + "SELECT term, (row_number() OVER (ORDER BY term) - 1)::BIGINT AS idx, df, tf, round(idf, 6) AS idf FROM vocab",
    ),
    "term_statistics": _with(TURNS, PREPARED, f"""words AS (SELECT "ID", {_words('"Cleaned_Text"')} AS w FROM prepared)""")
    + f"""SELECT term, count(DISTINCT "ID") AS df, count(*) AS tf, (SELECT count(*) FROM prepared) AS n_docs
FROM (SELECT "ID", unnest({_grams('w', 2)}) AS term FROM words) GROUP BY term""",
    "vocab_max_features": _with(DOCUMENTS, PREPARED, SPLIT, _tfidf(keep="df >= 0.01 * n AND df <= 0.5 * n"))
    + "SELECT term, df, tf, round(idf, 6) AS idf FROM vocab ORDER BY tf DESC, term LIMIT 500",
    "tfidf_train": _with(DOCUMENTS, PREPARED, SPLIT, _tfidf())
    + """SELECT "ID", term, tf, round(tfidf, 6) AS tfidf FROM feat WHERE split = 'train'""",
    "tfidf_test": _with(DOCUMENTS, PREPARED, SPLIT, _tfidf())
    + """SELECT "ID", term, tf, round(tfidf, 6) AS tfidf FROM feat WHERE split = 'test'""",
    "tfidf_plain": _with(TURNS, PREPARED, SPLIT, _tfidf(high=1, keep="df >= 1", tf="tf", idf="1.0::DOUBLE"))
    + """SELECT "ID", term, tf, round(tfidf, 6) AS tfidf FROM feat WHERE split = 'train'""",
    "tfidf_vectors": _with(TURNS, PREPARED, SPLIT, _tfidf())
    + """, positions AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx FROM vocab)
SELECT d."ID", (SELECT count(*) FROM vocab) AS width, count(f.term) AS n_nonzero,
  round(coalesce(sum(f.tfidf * f.tfidf), 0), 6) AS squared_length, coalesce(sum(idx), 0)::BIGINT AS index_sum
FROM sides d LEFT JOIN feat f ON f."ID" = d."ID" LEFT JOIN positions USING (term) WHERE d.split = 'train' GROUP BY 1""",
    "sparsity": _with(DOCUMENTS, PREPARED, SPLIT, _tfidf())
    + """SELECT n::BIGINT AS n_docs, v AS n_terms, nz AS n_nonzero, round(100 * (1 - nz / (n * v)), 6) AS sparsity_pct
FROM nd, (SELECT count(*) AS v FROM vocab), (SELECT count(*) AS nz FROM feat WHERE split = 'train')""",
    # Naive Bayes
    "label_encoding": """SELECT doc_id AS "ID", lang AS "Label", (dense_rank() OVER (ORDER BY lang) - 1)::BIGINT AS label_index FROM documents""",
    "class_weights": _with(DOCUMENTS, PREPARED, SPLIT)
    + """SELECT "Label" AS label, count(*) AS n, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
FROM sides WHERE split = 'train' GROUP BY 1""",
    "nb_theta": _with(*BAYES_TURNS) + "SELECT label, term, round(w, 6) AS weight FROM theta",
    "nb_predict": _with(*BAYES_TURNS)
    + """SELECT "ID", "Label", predicted_label, round(p, 6) AS predicted_probability, features AS features_present_count
FROM scored WHERE split = 'test'""",
    "nb_topk": _with(*BAYES_TURNS)
    + f"""SELECT "ID", rank, cls AS label, round(p, 4) AS probability, {PCT.format('p')} AS percentage FROM ranked WHERE split = 'test'""",
    "nb_documents_report": _with(*BAYES_DOCUMENTS, COUNTS, _labels("en", "fr", "de", "es"), REPORT) + REPORT_ROWS,
    "fused_nb_metrics": _with(*BAYES_TURNS, COUNTS, ROLES, REPORT, OVERALL)
    + f"""SELECT '1.0' AS "Model", {ROUNDED_OVERALL}, true AS "Supports_Proba" FROM overall
UNION ALL SELECT '0.1', {ROUNDED_OVERALL}, true FROM ("""
    + _with(*BAYES_TURNS[:4], THETA.replace("coalesce(s, 0) + 1) / (tot + v)", "coalesce(s, 0) + 0.1::DOUBLE) / (tot + 0.1::DOUBLE * v)"), SCORED, COUNTS, ROLES, REPORT, OVERALL)
    + "SELECT * FROM overall)",
    "lr_bayes_gradient": _with(*BAYES_TURNS)
    + """SELECT f.term, p.cls AS label, round(sum(f.tfidf * (p.p - CASE WHEN p.cls = f."Label" THEN 1 ELSE 0 END)), 6) + 0.0 AS gradient
FROM feat f JOIN prob p ON p."ID" = f."ID" WHERE f.split = 'train' GROUP BY ALL""",
    "lr_term_partitioned": _with(TURNS, PREPARED, SPLIT, _tfidf())
    + """SELECT l."Label" AS label, (SELECT count(*) FROM vocab) AS n_terms, true AS agrees
FROM (SELECT DISTINCT "Label" FROM sides WHERE split = 'train') l""",
    "nb_accuracy": _with(*BAYES_TURNS, COUNTS, ROLES, REPORT, OVERALL) + 'SELECT round("Accuracy", 6) AS "Accuracy" FROM overall',
    "nb_macro_weighted": _with(*BAYES_TURNS, COUNTS, ROLES, REPORT, OVERALL)
    + "SELECT "
    + ", ".join(
        f'round("{m}", 6) AS "{m}"'
        for m in (
            "Accuracy",
            "Macro_Precision",
            "Macro_Recall",
            "Macro_F1",
            "Weighted_Precision",
            "Weighted_Recall",
            "Weighted_F1",
        )
    )
    + " FROM overall",
    "class_report": _with(*BAYES_TURNS, COUNTS, ROLES_AND_ABSENT, REPORT) + REPORT_ROWS,
    "confusion_matrix": _with(*BAYES_TURNS, COUNTS, ROLES, CELLS) + "SELECT * FROM cells",
    "confusion_wide": _with(*BAYES_TURNS, COUNTS, ROLES, CELLS)
    + "SELECT actual, "
    + ", ".join(f"sum(n) FILTER (predicted = '{r}')::BIGINT AS \"{r}\"" for r in ("user", "assistant", "system"))
    + " FROM cells GROUP BY 1",
    "confusion_normalized": _with(*BAYES_TURNS, COUNTS, ROLES_AND_ABSENT, CELLS)
    + "SELECT actual, predicted, n, round(n / nullif(sum(n) OVER (PARTITION BY actual), 0), 6) AS share FROM cells",
    "metric_gate": _with(*BAYES_TURNS, COUNTS, ROLES, REPORT, OVERALL)
    + """SELECT 'Accuracy' AS metric, round("Accuracy", 6) AS value, 0.5::DOUBLE AS expected, abs("Accuracy" - 0.5) < 0.25 AS passed FROM overall
UNION ALL SELECT 'Macro_F1', round("Macro_F1", 6), 0.5::DOUBLE, abs("Macro_F1" - 0.5) < 0.25 FROM overall""",
    "error_analysis": _with(*BAYES_TURNS, ERRORS)
    + """SELECT e."ID", s."Text", s."Cleaned_Text", e."Label" AS "Actual_Label", e.predicted_label AS "Predicted_Label",
  e.confidence AS "Prediction_Confidence", """
    + ", ".join(f'r{i}.cls AS "Top_{i}_Class", round(r{i}.p, 4) AS "Top_{i}_Probability"' for i in (1, 2, 3))
    + """
FROM errors e JOIN sides s ON s."ID" = e."ID"\n"""
    + "\n".join(f'JOIN ranked r{i} ON r{i}."ID" = e."ID" AND r{i}.rank = {i}' for i in (1, 2, 3)),
    "error_pairs": _with(*BAYES_TURNS, COUNTS)
    + """SELECT actual AS "Actual_Label", predicted AS "Predicted_Label", n AS "Error_Count", pct AS "Pct_of_Actual_Class"
FROM (SELECT *, round(n / sum(n) OVER (PARTITION BY actual) * 100, 2) AS pct FROM counts) WHERE actual <> predicted
ORDER BY n DESC, actual, predicted LIMIT 10""",
    "confidence_strata": _with(*BAYES_TURNS, ERRORS)
    + """, strata AS (
  SELECT 'high' AS stratum, count(*) FILTER (confidence >= 0.7) AS n FROM errors
  UNION ALL SELECT 'medium', count(*) FILTER (confidence >= 0.4 AND confidence < 0.7) FROM errors
  UNION ALL SELECT 'low', count(*) FILTER (confidence < 0.4) FROM errors)
SELECT stratum, n, round(n * 100 / nullif(sum(n) OVER (), 0), 2) AS pct FROM strata""",
    "nb_top_features": _with(*BAYES_TURNS)
    + """SELECT label AS "Class", rank AS "Rank", term AS "Feature", round(w, 4) AS "Coefficient"
FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY w DESC, term) AS rank FROM theta) WHERE rank <= 20""",
    "nb_explain": _with(*BAYES_TURNS, EXPLAINED)
    + """, ordered AS (
  SELECT *, row_number() OVER (PARTITION BY "ID" ORDER BY contribution DESC, term) AS rank,
    count(*) FILTER (contribution > 0) OVER (PARTITION BY "ID") AS n_positive FROM contributions)
SELECT "ID", predicted_label, features AS features_present_count, rank, term, contribution, round(tfidf, 4) AS tfidf,
  round(w, 4) AS coefficient, is_positive
FROM ordered WHERE rank <= 5 AND (n_positive = 0 OR contribution > 0)""",
    "nb_explain_all_terms": _with(*BAYES_TURNS, EXPLAINED)
    + 'SELECT "ID", term, contribution, round(tfidf, 4) AS tfidf FROM contributions',
    # Scoring
    "batch_errors": _with(*BAYES_TURNS)
    + f"""SELECT "ID", CASE WHEN error IS NULL THEN predicted_label END AS predicted_label,
  CASE WHEN error IS NULL THEN round(p, 4) END AS predicted_probability,
  CASE WHEN error IS NULL THEN {PCT.format('p')} END AS confidence_percentage, error
FROM (SELECT *, CASE WHEN "Label" = 'system' AND "ID" % 2 = 0 THEN 'input is blank'
  WHEN "Label" = 'system' THEN 'input has no readable text' END AS error FROM scored)""",
    "predict_and_explain": _with(*BAYES_TURNS, EXPLAINED.replace("WHERE s.split = 'test'", ""))
    + """, first_term AS (
  SELECT "ID", term FROM (SELECT *, row_number() OVER (PARTITION BY "ID" ORDER BY contribution DESC, term) AS rank FROM contributions) WHERE rank = 1)
SELECT s."ID", s.predicted_label, round(s.p, 4) AS predicted_probability, s.features AS features_present_count,
  r.cls AS second_label, t.term AS top_term, 3::BIGINT AS n_classes
FROM scored s JOIN ranked r ON r."ID" = s."ID" AND r.rank = 2 LEFT JOIN first_term t ON t."ID" = s."ID" """,
    "score_unseen": _with(
        """corpus AS (SELECT doc_id AS "ID", text AS "Text", lang AS "Label" FROM documents)""",
        PREPARED,
        QUOTA,
        SIDES.replace("sides AS", "known AS"),
        f"""sides AS (
  SELECT "ID", "Label", "Cleaned_Text", split FROM known
  UNION ALL SELECT -1 - item_id, NULL, {_clean('text')}, 'new' FROM benchmark)""",
        _tfidf(),
        THETA,
        SCORED,
    )
    + f"""SELECT -1 - "ID" AS "ID", predicted_label, round(p, 4) AS predicted_probability, {PCT.format('p')} AS confidence_percentage
FROM scored WHERE split = 'new'""",
    "prediction_export": _with(*BAYES_TURNS)
    + f"""SELECT d."Text" AS "Headline", r1.cls AS "Predicted Category", {PCT.format('round(r1.p, 4)')} AS "Model Probability", """
    + ", ".join(f"""r{i}.cls || ' (' || {PCT.format(f'round(r{i}.p, 4)')} || ')' AS "Top {i}" """ for i in (1, 2, 3))
    + """, strftime(make_timestamp(d."ID" * 1000000), '%Y-%m-%dT%H:%M:%S.') || '000Z' AS "Timestamp"
FROM sides d\n"""
    + "\n".join(f'JOIN ranked r{i} ON r{i}."ID" = d."ID" AND r{i}.rank = {i}' for i in (1, 2, 3)),
    "model_roundtrip": _with(*BAYES_TURNS)
    + """SELECT "ID", "Label", predicted_label, round(p, 6) AS predicted_probability FROM scored WHERE split = 'test'""",
    "model_metadata": _with(*BAYES_TURNS)
    + """SELECT 'Multinomial Naive Bayes' AS model, (SELECT string_agg(label, ',' ORDER BY label) FROM prior) AS classes,
  (SELECT n::BIGINT FROM nd) AS training_documents, (SELECT count(*) FROM vocab) AS vocabulary_size""",
    "model_versions": _with(*BAYES_TURNS)
    + r"""SELECT p::BIGINT AS publication, '[\u0900-\u097F\p{L}\p{N}_]+' AS token_pattern, alpha, most AS max_features,
  (SELECT n::BIGINT FROM nd) AS training_documents, (SELECT least(count(*), coalesce(most, count(*))) FROM vocab) AS stored_terms,
  p <> 2 AS is_current
FROM (VALUES (1, '1.0', NULL::BIGINT), (2, '0.5', 500), (3, '1.0', NULL)) v(p, alpha, most)""",
    "stream_score": _with(*BAYES_TURNS)
    + f"""SELECT "ID", predicted_label, round(p, 4) AS predicted_probability, {PCT.format('p')} AS confidence_percentage FROM scored""",
    "recent_predictions": _with(*BAYES_TURNS)
    + """SELECT "Label", position, "ID", predicted_label FROM (
  SELECT s.*, row_number() OVER (PARTITION BY s."Label" ORDER BY c.conv_id DESC, c.turn DESC) AS position
  FROM scored s JOIN corpus c ON c."ID" = s."ID") WHERE position <= 20""",
    "score_repeated_ids": _with(*BAYES_TURNS)
    + """SELECT CASE WHEN c.turn % 5 <> 4 THEN c.conv_id END AS "ID", c.conv_id, c.turn, s.predicted_label,
  round(s.p, 4) AS predicted_probability, NULL::VARCHAR AS error
FROM scored s JOIN corpus c ON c."ID" = s."ID" """,
    "explain_repeated_ids": _with(*BAYES_TURNS)
    + """SELECT CASE WHEN c.turn % 5 <> 4 THEN c.conv_id END AS "ID", c.conv_id, c.turn, s.predicted_label,
  s.features AS features_present_count
FROM scored s JOIN corpus c ON c."ID" = s."ID" """,
    "all_class_probabilities": _with(*BAYES_TURNS)
    + """SELECT "ID", cls AS label, round(p, 4) AS probability FROM ranked""",
    "lr_explain_terms": _with(*BAYES_TURNS, EXPLAINED) + """SELECT "ID", term, round(tfidf, 4) AS tfidf FROM contributions""",
    "csv_reordered": """SELECT doc_id AS "ID", text AS "Text", lang AS "Label", source AS "Original_Label" FROM documents""",
    "duplicate_id_members": """SELECT conv_id, turn, n AS copies
FROM (SELECT conv_id, turn, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations) WHERE n > 1""",
    "duplicate_cleaned_members": _with(DOCUMENTS, PREPARED)
    + """SELECT "ID", n AS copies
FROM (SELECT "ID", count(*) OVER (PARTITION BY "Cleaned_Text") AS n FROM prepared) WHERE n > 1""",
    "production_refit": _with(
        TURNS,
        PREPARED,
        """sides AS (SELECT "ID", "Label", "Cleaned_Text", 'train' AS split FROM prepared)""",
        _tfidf(),
    )
    + """SELECT 'Logistic Regression (Balanced)' AS model, (SELECT string_agg(DISTINCT "Label", ',' ORDER BY "Label") FROM sides) AS classes,
  (SELECT n::BIGINT FROM nd) AS training_documents, (SELECT count(*) FROM vocab) AS vocabulary_size""",
    "lr_calibration": _with(TURNS, PREPARED, SPLIT)
    + """SELECT "Label" AS label, round(count(*) / (SELECT count(*) FROM sides WHERE split = 'train'), 3) AS mean_probability
FROM sides WHERE split = 'train' GROUP BY 1""",
    "lr_balanced_calibration": _with(TURNS, PREPARED, SPLIT)
    + """SELECT "Label" AS label, round(1.0::DOUBLE / (SELECT count(DISTINCT "Label") FROM sides WHERE split = 'train'), 3) AS mean_probability
FROM sides WHERE split = 'train' GROUP BY 1""",
}
# What the stream has kept is what the batch finds in the whole log.
ORACLE_SQL["recent_stream"] = ORACLE_SQL["recent_predictions"]
