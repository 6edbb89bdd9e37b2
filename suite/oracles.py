"""The registered queries in DuckDB SQL. What training learns is checked by properties that SQL can state."""

from __future__ import annotations

from recado.profiles import PT_TAXONOMY
from suite import sql as q
from suite.adapters import NO_TEXT_IDS, OPEN_KINDS
from suite.profile import TAXONOMY, TEST
from suite.queries import REPLAY_END, REPLAY_START, SINCE, WEEK

ORACLES: dict[str, str] = {}

_RESULTS = "interaction_date, user_name, url, content_type, original_text, cluster, sentimento, problema, problema_30d, order_number"


def _text(name: str, expression: str) -> None:
    ORACLES[name] = f"WITH {q.TEXTS} SELECT comment_id, {expression} AS result FROM texts"


# -- sources and sinks ---------------------------------------------------------------------------

ORACLES["extract_events"] = f"""
SELECT event_id AS comment_id, strftime(ts, '%Y-%m-%d') AS interaction_date, 'User_' || user_id AS user_name,
  'https://social.example/e/' || event_id AS url, props AS text
FROM events WHERE event_type = 'click' AND user_id % 13 <> 0 AND user_id <> 8 AND ts >= TIMESTAMP '{SINCE}'"""

for _dialect in ("train", "infer", "replay"):
    ORACLES[f"csv_roundtrip_{_dialect}"] = (
        f"WITH {q.COMMENTS} SELECT comment_id, interaction_date, user_name, url, content_type, text FROM comments")

ORACLES["extract_landed"] = ORACLES["extract_events"]
ORACLES["lookup_json_read"] = f"WITH {q.event_sentences()}, {q.EVENT_LOOKUP} SELECT subclusters_id, cluster, problema FROM lookup"
ORACLES["lookup_roundtrip"] = f"WITH {q.event_sentences()}, {q.EVENT_LOOKUP} SELECT subclusters_id, cluster, problema, size FROM lookup"

ORACLES["latest_model"] = """
SELECT 'models/' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS path, strftime(o_orderdate, '%Y-%m-%d') AS created_at
FROM orders WHERE lower(o_orderpriority) LIKE '%urgent%' ORDER BY o_orderdate DESC, path DESC LIMIT 1"""

_EVENT_RESULTS = f"""{q.event_sentences()}, {q.EVENT_LOOKUP},
joined AS (SELECT * FROM sentences JOIN lookup USING (subclusters_id)),
{q.sentiment('joined')},
results AS (SELECT strftime(interaction_date, '%Y-%m-%d') AS interaction_date, user_name, url, content_type, original_text,
  cluster, sentimento, problema, problema AS problema_30d, {q.order_number('original_text')} AS order_number FROM felt)"""

for _name in ("results_csv_roundtrip", "result_projection", "sorted_results"):
    ORACLES[_name] = f"WITH {_EVENT_RESULTS} SELECT {_RESULTS} FROM results"

ORACLES["upsert_results"] = f"""WITH {_EVENT_RESULTS},
incoming AS (SELECT * REPLACE ('12345678' AS order_number) FROM results WHERE interaction_date >= '2024-01-20')
SELECT {_RESULTS} FROM results r WHERE NOT EXISTS (SELECT 1 FROM incoming i
  WHERE i.interaction_date IS NOT DISTINCT FROM r.interaction_date AND i.user_name IS NOT DISTINCT FROM r.user_name
    AND i.original_text IS NOT DISTINCT FROM r.original_text)
UNION ALL SELECT {_RESULTS} FROM incoming"""

# -- comments ------------------------------------------------------------------------------------

ORACLES["drop_null_text"] = f"WITH {q.COMMENTS} SELECT comment_id, text FROM comments WHERE text IS NOT NULL"
ORACLES["dedupe_comments"] = (
    f"WITH {q.DEDUPED} SELECT comment_id, interaction_date, user_name, url, content_type, text FROM deduped")
ORACLES["duplicate_ratio"] = f"""WITH {q.COMMENTS}, per_key AS (
  SELECT text, user_name, count(*) AS n FROM comments WHERE text IS NOT NULL GROUP BY ALL)
SELECT round(100 * (sum(n) - count(*)) / sum(n), 2) AS duplicate_pct FROM per_key"""
ORACLES["canonical_url_path"] = f"SELECT page_id, {q.post_path('url')} AS post_url FROM pages"
ORACLES["canonical_url_query"] = f"SELECT page_id, {q.post_query('url')} AS post_url FROM pages"
ORACLES["publish_date"] = f"""WITH {q.COMMENTS}, posts AS (SELECT * REPLACE ({q.post_path('url')} AS url) FROM comments)
SELECT comment_id, url, interaction_date, min(interaction_date) OVER (PARTITION BY url) AS publish_date FROM posts"""
ORACLES["filter_mentions"] = f"WITH {q.TEXTS} SELECT comment_id, text FROM texts WHERE NOT {q.foreign_mention('text')}"
ORACLES["filter_names"] = f"WITH {q.TEXTS} SELECT comment_id, text FROM texts WHERE NOT {q.name_first('text')}"

# -- text ----------------------------------------------------------------------------------------

_text("norm_lower", "lower(text)")
_text("strip_handles", q.strip_handles("text"))
_text("strip_brand", q.strip_brand("lower(text)"))
_text("norm_punct", q.marks("text"))
_text("remove_stopwords", q.no_stops("lower(text)"))
_text("norm_residue", q.residue("text"))
_text("letters_only", q.letters("text"))
_text("word_count", q.n_words("text"))
_text("length_class", f"CASE WHEN {q.n_words('text')} < {TEST.lower_limit} THEN 'small' "
                      f"WHEN {q.n_words('text')} > {TEST.upper_limit} THEN 'large' ELSE 'medium' END")
_text("strip_accents", q.accents("text"))
_text("synonyms", q.synonyms("lower(text)"))
_text("useless_terms", q.useless("lower(text)"))
_text("order_number", q.order_number("text"))
_text("tokenize", f"array_to_string({q.words('text')}, '|')")
ORACLES["bigrams"] = f"""WITH {q.TEXTS}, split AS (SELECT comment_id, {q.words('text')} AS ws FROM texts)
SELECT comment_id, array_to_string(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]), '|') AS result FROM split"""

_PIECES = f"""{q.TEXTS},
lowered AS (SELECT comment_id, {q.strip_handles('lower(text)')} AS text FROM texts),
marked AS (SELECT comment_id, {q.marks('(' + q.strip_brand('text') + ')')} AS text FROM lowered),
split AS (SELECT comment_id, {q.split_sentences('text')} AS parts FROM marked),
pieces AS (SELECT comment_id, unnest(parts) AS text, generate_subscripts(parts, 1) - 1 AS sentence_idx FROM split)"""

_LETTERS = f"""{_PIECES},
stopped AS (SELECT comment_id, sentence_idx, {q.no_stops('text')} AS text FROM pieces),
sentences AS (SELECT comment_id, sentence_idx, {q.letters(q.residue('text'))} AS text FROM stopped)"""

_SYNONYMS = f"{_LETTERS}, synon AS (SELECT comment_id, sentence_idx, {q.synonyms(q.accents('text'))} AS text FROM sentences)"

ORACLES["explode_sentences"] = f"WITH {_PIECES} SELECT comment_id, sentence_idx, text FROM pieces"
ORACLES["learn_abbreviations"] = r"""WITH tokens AS (
  SELECT unnest(regexp_split_to_array(lower(text), '[\x09-\x0d\x20\x{85}\p{Z}]+')) AS token FROM documents WHERE text IS NOT NULL),
words AS (SELECT regexp_extract(token, '(\p{L}(?:[\p{L}.]*\p{L})?)(\.?)', 1) AS word,
                 regexp_extract(token, '(\p{L}(?:[\p{L}.]*\p{L})?)(\.?)', 2) = '.' AS stop FROM tokens),
counts AS (SELECT word, count(*) FILTER (WHERE stop) AS n_stop, count(*) FILTER (WHERE NOT stop) AS n_plain FROM words WHERE word <> '' GROUP BY word),
chances AS (SELECT sum(n_stop) / sum(n_stop + n_plain) AS p FROM counts),
scored AS (
  SELECT word, n_stop, n_plain, length(replace(word, '.', '')) AS letters,
         2 * (n_stop * ln(0.99::DOUBLE) + n_plain * ln(1 - 0.99::DOUBLE) - n_stop * ln(p) - n_plain * ln(1 - p)) AS ratio
  FROM counts, chances WHERE n_stop > 0)
SELECT word, n_stop, n_plain, round(ratio * exp(-letters) * (length(word) - letters + 1) * pow(letters::DOUBLE, -n_plain), 4) + 0.0 AS score,
       ratio * exp(-letters) * (length(word) - letters + 1) * pow(letters::DOUBLE, -n_plain) >= 0.3 AS is_abbreviation FROM scored"""
ORACLES["stopword_list"] = rf"""WITH {q.TEXTS}, words AS (
  SELECT unnest(string_split({q.rx('lower(text)', r'[^\p{L}\p{N}_]+', ' ')}, ' ')) AS word FROM texts)
SELECT word, count(*) AS n FROM words WHERE list_contains({q.listing(TEST.all_stop_words())}, word) GROUP BY word"""
ORACLES["length_filter"] = f"WITH {_LETTERS} SELECT comment_id, sentence_idx, text FROM sentences WHERE {q.sized('text')}"
ORACLES["length_report"] = f"""WITH {_LETTERS}, counted AS (SELECT {q.n_words('text')} AS n FROM sentences)
SELECT count(*) FILTER (WHERE n < {TEST.lower_limit}) AS n_small, count(*) FILTER (WHERE n > {TEST.upper_limit}) AS n_large,
  count(*) FILTER (WHERE n BETWEEN {TEST.lower_limit} AND {TEST.upper_limit}) AS n_kept, count(*) AS n_total FROM counted"""
ORACLES["lemmatize_lexicon"] = f"WITH {_LETTERS} SELECT comment_id, sentence_idx, {q.lemmas('text')} AS text FROM sentences"
ORACLES["lexicon_conllu"] = f"""WITH {q.TEXTS}, words AS (SELECT unnest(string_split(text, ' ')) AS w FROM texts)
SELECT w AS surface, CASE WHEN length(w) % 2 = 0 THEN 'NOUN' ELSE 'VERB' END AS pos, w || 'ar' AS lemma FROM words
WHERE regexp_full_match(w, '[a-z]+') AND (length(w) % 2 = 0 OR length(w) % 3 <> 0) GROUP BY w HAVING count(*) >= 5"""
_KINDS = [(int(n), {"ADJ": 2, "ADP": 3, "NOUN": 4, "VERB": 5}[pos], "" if pos == "ADP" else end)
          for n, pos, end in (kind.split(":") for kind in OPEN_KINDS)]
ORACLES["lemmatize_context"] = f"""WITH RECURSIVE {_LETTERS},
medium AS (SELECT comment_id, sentence_idx, string_split(text, ' ') AS words FROM sentences WHERE {q.sized('text')}),
toks AS (SELECT comment_id, sentence_idx, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM medium),
kinds(n, tag, ending) AS (VALUES {", ".join(f"({n}, {tag}, '{end}')" for n, tag, end in _KINDS)}),
options AS (SELECT comment_id, sentence_idx, pos, coalesce(tag, 1) AS tag,
                   CASE WHEN list_contains({q.listing(TEST.lemma_exempt)}, word) THEN word ELSE word || coalesce(ending, '') END AS lemma
            FROM toks LEFT JOIN kinds ON length(word) % 7 = n),
framed AS (SELECT comment_id, sentence_idx, pos, min(tag) AS tag, count(*) AS ways FROM options GROUP BY ALL
           UNION ALL SELECT comment_id, sentence_idx, unnest([0, len(words) + 1]), 0, 1 FROM medium),
pairs AS (SELECT x.tag AS i, y.tag AS j, count(*) AS n FROM framed x JOIN framed y
          ON x.comment_id = y.comment_id AND x.sentence_idx = y.sentence_idx AND y.pos = x.pos + 1
          WHERE x.ways = 1 AND y.ways = 1 GROUP BY ALL),
costs AS (SELECT i, j, CAST(round(1000 * ln((sum(coalesce(n, 0)) OVER (PARTITION BY i) + 6.0::DOUBLE) / (coalesce(n, 0) + 1))) AS BIGINT) AS c
          FROM (SELECT unnest(range(6)) AS i) CROSS JOIN (SELECT unnest(range(6)) AS j) LEFT JOIN pairs USING (i, j)),
paths(comment_id, sentence_idx, pos, tag, best) AS (
  SELECT comment_id, sentence_idx, 0::BIGINT, 0, {{'cost': 0::BIGINT, 'path': []::STRUCT(tag INTEGER, lemma VARCHAR)[]}} FROM medium
  UNION ALL
  SELECT p.comment_id, p.sentence_idx, o.pos, o.tag,
         min({{'cost': p.best.cost + c.c, 'path': list_append(p.best.path, {{'tag': o.tag, 'lemma': o.lemma}})}})
  FROM paths p JOIN options o ON p.comment_id = o.comment_id AND p.sentence_idx = o.sentence_idx AND o.pos = p.pos + 1
  JOIN costs c ON c.i = p.tag AND c.j = o.tag
  GROUP BY p.comment_id, p.sentence_idx, o.pos, o.tag),
ended AS (SELECT p.comment_id, p.sentence_idx, min({{'cost': p.best.cost + c.c, 'path': p.best.path}}) AS best
          FROM paths p JOIN medium m ON p.comment_id = m.comment_id AND p.sentence_idx = m.sentence_idx AND p.pos = len(m.words)
          JOIN costs c ON c.i = p.tag AND c.j = 0 GROUP BY p.comment_id, p.sentence_idx)
SELECT comment_id, sentence_idx, array_to_string(list_transform(best.path, lambda w: w.lemma), ' ') AS text FROM ended"""
ORACLES["mandatory_filter"] = f"WITH {_SYNONYMS} SELECT comment_id, sentence_idx, text FROM synon WHERE {q.any_of('text', TEST.mandatory)}"
ORACLES["blacklist_filter"] = f"WITH {_SYNONYMS} SELECT comment_id, sentence_idx, text FROM synon WHERE NOT {q.any_of('text', TEST.blacklist)}"
ORACLES["mandatory_report"] = f"""WITH {_SYNONYMS}
SELECT round(100.0 * count(*) FILTER (WHERE NOT {q.any_of('text', TEST.mandatory)} OR {q.any_of('text', TEST.blacklist)})
  / count(*), 1) AS removed_pct FROM synon"""
_WORDS = f"SELECT unnest({q.words(q.accents(q.letters('lower(text)')))}) AS word FROM texts"
ORACLES["stem_vocabulary"] = f"WITH {q.TEXTS}, {q.stem_ctes(_WORDS, 'word')} SELECT w AS word, stem FROM stems"
ORACLES["drop_blank"] = f"""WITH {_LETTERS}, used AS (
  SELECT comment_id, sentence_idx, {q.collapse(q.useless('text'))} AS text FROM sentences)
SELECT * FROM used WHERE text NOT IN ('', ' ')"""

# -- composed cleaning ---------------------------------------------------------------------------

_SENTENCE_COLUMNS = "comment_id, interaction_date, user_name, url, content_type, publish_date, original_text, sentence_idx"
ORACLES["clean_kept"] = f"WITH {q.SENTENCES} SELECT {_SENTENCE_COLUMNS}, text FROM cleaned WHERE reject_reason IS NULL"
ORACLES["clean_repeated"] = ORACLES["clean_lexicon"] = ORACLES["clean_kept"]
ORACLES["bad_dates"] = f"""WITH {q.SENTENCES.replace("WHERE text IS NOT NULL", "WHERE text IS NOT NULL AND comment_id % 11 <> 5", 1)}
SELECT comment_id, count(*) AS n, CAST(NULL AS VARCHAR) AS bad_date FROM cleaned GROUP BY comment_id
UNION ALL SELECT comment_id, 0, '31/13/2024' FROM comments WHERE text IS NOT NULL AND comment_id % 11 = 5"""
ORACLES["clean_removed"] = f"WITH {q.SENTENCES} SELECT {_SENTENCE_COLUMNS}, reject_reason, text FROM cleaned WHERE reject_reason IS NOT NULL"
ORACLES["clean_counts"] = f"""WITH {q.SENTENCES}, sizes AS (SELECT {q.n_words('t_letters')} AS n FROM lettered),
by_size AS (SELECT count(*) AS n_sentences, count(*) FILTER (WHERE n < {TEST.lower_limit}) AS n_small, count(*) FILTER (WHERE n > {TEST.upper_limit}) AS n_large,
  count(*) FILTER (WHERE n BETWEEN {TEST.lower_limit} AND {TEST.upper_limit}) AS n_medium FROM sizes),
by_reason AS (SELECT count(*) AS n_written, count(*) FILTER (WHERE reject_reason IS NULL) AS n_kept,
  {', '.join(f"count(*) FILTER (WHERE reject_reason = '{r}') AS n_{r}" for r in ("mention", "name", "mandatory", "blacklist", "blank"))} FROM cleaned),
given AS (SELECT count(*) AS n_comments FROM comments WHERE text IS NOT NULL), once AS (SELECT count(*) AS n FROM deduped)
SELECT by_size.*, by_reason.*, n_comments, round(100 * (n_comments - n) / n_comments, 2) AS duplicate_pct,
  round(100 * (n_mandatory + n_blacklist) / n_medium, 1) AS removed_pct FROM by_size, by_reason, given, once"""
ORACLES["rejected_rows"] = f"WITH {q.SENTENCES} SELECT coalesce(reject_reason, 'kept') AS outcome, count(*) AS n FROM cleaned GROUP BY 1"


def _trace() -> str:
    whole = [("deduped", "tagged", "text", "TRUE"), ("mentions", "tagged", "text", "coalesce(reason, '') <> 'mention'"),
             ("names", "tagged", "text", "reason IS NULL"), ("lower", "lowered", "t_lower", "TRUE"),
             ("handles", "handled", "t_handles", "TRUE"), ("brand", "branded", "t_brand", "TRUE"), ("marks", "marked", "t_marks", "TRUE")]
    piece = [("sentences", "pieces", "t_sentences"), ("stop_words", "stopped", "t_stop_words"), ("residue", "resid", "t_residue"),
             ("letters", "lettered", "t_letters"), ("length", "medium", "t_letters"), ("lemmas", "lemmad", "t_lemmas"),
             ("accents", "plain", "t_accents"), ("synonyms", "synon", "t_synonyms"), ("mandatory", "used", "t_synonyms"),
             ("useless", "used", "t_useless"), ("stems", "final", "t_final")]
    parts = [f"SELECT comment_id, -1 AS sentence_idx, '{s}' AS stage, {c} AS text FROM {f} WHERE {w}" for s, f, c, w in whole]
    parts += [f"SELECT comment_id, sentence_idx, '{s}' AS stage, {c} AS text FROM {f}" for s, f, c in piece]
    parts.append("SELECT comment_id, sentence_idx, 'final' AS stage, t_final AS text FROM final WHERE t_final <> ''")
    return f"WITH {q.SENTENCES} " + " UNION ALL ".join(parts)


ORACLES["clean_trace"] = _trace()
ORACLES["vocab_report"] = f"""WITH {q.SENTENCES}, stages AS (
  SELECT 'before_lemmas' AS stage, unnest({q.words('t_letters')}) AS word FROM medium UNION ALL
  SELECT 'after_lemmas', unnest({q.words('t_lemmas')}) FROM lemmad UNION ALL
  SELECT 'before_stems', unnest({q.words('t_useless')}) FROM used UNION ALL
  SELECT 'after_stems', unnest({q.words('t_final')}) FROM final)
SELECT stage, count(DISTINCT word) AS n_words FROM stages GROUP BY stage"""

# -- vectors and clusters ------------------------------------------------------------------------

ORACLES["vocab_min_count"] = f"""WITH {q.TEXTS}, words AS (SELECT unnest({q.words('text')}) AS word FROM texts)
SELECT word, count(*) AS n FROM words GROUP BY word HAVING count(*) >= 10"""
_MEANS = """points AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings),
means AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS value FROM points GROUP BY ALL)"""
ORACLES["mean_vector"] = f"WITH {_MEANS} SELECT label, i, round(value, 6) AS value FROM means"
ORACLES["assign_cluster"] = f"""WITH {_MEANS}, distances AS (
  SELECT p.vec_id, m.label, round(sum((CAST(p.x AS DOUBLE) - round(m.value, 4)) * (CAST(p.x AS DOUBLE) - round(m.value, 4))), 6) AS d
  FROM points p JOIN means m USING (i) GROUP BY ALL)
SELECT vec_id, label AS subclusters_id FROM distances QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, label) = 1"""
_KNOWN = f"""{_LETTERS}, tokens AS (SELECT comment_id, sentence_idx, unnest({q.words('text')}) AS word FROM sentences),
known AS (SELECT word FROM tokens GROUP BY word HAVING count(*) >= 10)"""
ORACLES["word2vec_fit"] = f"WITH {_KNOWN} SELECT word, 200 AS n_dimensions FROM known"
ORACLES["sentence_vectors"] = f"""WITH {_KNOWN}, counted AS (SELECT comment_id, sentence_idx, count(*) AS n FROM tokens JOIN known USING (word) GROUP BY ALL)
SELECT comment_id, sentence_idx, coalesce(n, 0) AS n_known, TRUE AS is_mean FROM sentences LEFT JOIN counted USING (comment_id, sentence_idx)"""
ORACLES["kmeans_fit"] = "SELECT vec_id, TRUE AS at_nearest FROM embeddings"
ORACLES["train_pipeline"] = f"""WITH {q.SENTENCES}
SELECT count(*) AS n_sentences, TRUE AS within_k, TRUE AS one_row_each FROM cleaned WHERE reject_reason IS NULL"""
ORACLES["model_roundtrip"] = f"WITH {q.SENTENCES} SELECT count(*) AS n_sentences, 0::BIGINT AS n_changed FROM cleaned WHERE reject_reason IS NULL"
ORACLES["cluster_size"] = f"WITH {q.event_sentences()}, {q.EVENT_LOOKUP} SELECT subclusters_id, cluster, problema, size FROM lookup"

# -- naming --------------------------------------------------------------------------------------

_CLUSTERED = f"""docs AS (SELECT doc_id, CAST(substr(source, 4) AS INTEGER) AS subclusters_id,
  {q.strip_handles('lower(text)')} AS text FROM documents),
marked AS (SELECT doc_id, subclusters_id, {q.marks('(' + q.strip_brand('text') + ')')} AS text FROM docs),
split AS (SELECT doc_id, subclusters_id, {q.split_sentences('text')} AS parts FROM marked),
pieces AS (SELECT doc_id, subclusters_id, unnest(parts) AS text FROM split),
stopped AS (SELECT doc_id, subclusters_id, {q.no_stops('text')} AS text FROM pieces),
lettered AS (SELECT doc_id, subclusters_id, {q.letters(q.residue('text'))} AS text FROM stopped),
medium AS (SELECT subclusters_id, {q.words('text')} AS ws FROM lettered WHERE {q.sized('text')}),
pairs AS (SELECT subclusters_id, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS bigram FROM medium)"""
_COUNTS = f"{_CLUSTERED}, counts AS (SELECT subclusters_id, bigram, count(*) AS n FROM pairs GROUP BY ALL)"
_TOP = f"""{_COUNTS}, top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY subclusters_id ORDER BY n DESC, bigram) AS rnk
  FROM counts) WHERE rnk <= 4)"""
_TERMS = f"terms AS ({q.values(TAXONOMY.label_terms(), 'label, label_ord, term')})"
_PROBLEMS = f"problems AS ({q.values(TAXONOMY.problem_labels(), 'problema, problem_ord, label')})"
_NAMES = f"""{_TOP}, {_TERMS}, {_PROBLEMS},
names AS (SELECT subclusters_id, first(label ORDER BY rnk, label_ord) FILTER (WHERE label IS NOT NULL) AS cluster
          FROM top LEFT JOIN terms ON term = bigram GROUP BY 1),
named AS (SELECT subclusters_id, cluster, (SELECT first(problema ORDER BY problem_ord) FROM problems WHERE label = cluster) AS problema FROM names)"""

ORACLES["bigram_counts"] = f"WITH {_COUNTS} SELECT subclusters_id, bigram, n FROM counts"
ORACLES["top_bigrams"] = f"WITH {_TOP} SELECT subclusters_id, bigram, n, rnk FROM top"
ORACLES["cluster_name"] = f"WITH {_NAMES} SELECT subclusters_id, cluster FROM names"
ORACLES["cluster_problem"] = f"WITH {_NAMES} SELECT subclusters_id, cluster, problema FROM named"
_LABEL_COUNTS = f"""{_CLUSTERED}, {_TERMS}, {_PROBLEMS},
found AS (SELECT label, term, count(bigram) AS n FROM terms LEFT JOIN pairs ON bigram = term GROUP BY ALL)"""
ORACLES["audit_labels_no_problem"] = f"""WITH {_LABEL_COUNTS}
SELECT label, CAST(sum(n) AS BIGINT) AS n_bigrams FROM found WHERE label NOT IN (SELECT label FROM problems) GROUP BY label"""
ORACLES["audit_duplicate_terms"] = f"""WITH {_LABEL_COUNTS}
SELECT term, count(*) AS n, max(n) AS n_bigrams FROM found GROUP BY term HAVING count(*) > 1"""
ORACLES["audit_unnamed_clusters"] = f"""WITH {_NAMES}
SELECT subclusters_id, rnk, bigram FROM top WHERE subclusters_id IN (SELECT subclusters_id FROM names WHERE cluster IS NULL)"""
ORACLES["cluster_lookup"] = f"""WITH {_NAMES}, sizes AS (SELECT subclusters_id, count(*) AS size FROM medium GROUP BY 1)
SELECT subclusters_id, cluster, problema, size FROM sizes LEFT JOIN named USING (subclusters_id)"""

_PT_TERMS = q.listing([x for _, _, x in PT_TAXONOMY.label_terms()])
_N_TERMS = len(PT_TAXONOMY.label_terms())
_PT_SENTENCES = f"""listed AS (SELECT {_PT_TERMS} AS t),
medium AS (SELECT CAST(event_id % 140 AS INTEGER) AS subclusters_id,
  t[((event_id % 140) * 3) % {_N_TERMS} + 1] || ' ' || t[(event_id // 3) % {_N_TERMS} + 1] AS text FROM events, listed),
tokens AS (SELECT subclusters_id, {q.words('text')} AS ws FROM medium),
pairs AS (SELECT subclusters_id, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS bigram FROM tokens),
counts AS (SELECT subclusters_id, bigram, count(*) AS n FROM pairs GROUP BY ALL)"""
ORACLES["cluster_lookup_pt"] = (ORACLES["cluster_lookup"].replace(_COUNTS, _PT_SENTENCES)
                                .replace(_TERMS, f"terms AS ({q.values(PT_TAXONOMY.label_terms(), 'label, label_ord, term')})")
                                .replace(_PROBLEMS, f"problems AS ({q.values(PT_TAXONOMY.problem_labels(), 'problema, problem_ord, label')})"))

# -- labelling -----------------------------------------------------------------------------------


def _labelled(teams: bool = False) -> str:
    return f"""{q.event_sentences(teams)}, {q.EVENT_LOOKUP},
labelled AS (SELECT * FROM sentences JOIN lookup USING (subclusters_id)),
{q.sentiment('labelled')}"""


ORACLES["join_lookup"] = f"WITH {_labelled()} SELECT comment_id, subclusters_id, cluster, problema, size FROM labelled"
ORACLES["append_rejected"] = f"""WITH {_labelled()}
SELECT comment_id, sentence_idx, user_name, original_text, cluster, problema FROM labelled
UNION ALL SELECT conv_id, turn, role, text, NULL, NULL FROM conversations"""
ORACLES["sentiment"] = f"WITH {_labelled()} SELECT comment_id, cluster, sentimento FROM felt"
ORACLES["comment_label_mode"] = f"""WITH {_labelled(True)}, {q.MODES}
SELECT user_name, original_text, sentimento, cluster_mode, CAST(n_rows AS BIGINT) AS n_rows FROM modes"""
ORACLES["apply_label_mode"] = f"WITH {_labelled(True)}, {q.APPLIED} SELECT comment_id, sentimento, cluster, problema FROM applied"
ORACLES["one_row_per_comment"] = f"""WITH {_labelled()}, {q.CHOSEN} SELECT comment_id, original_text, sentimento, size FROM chosen"""
ORACLES["label_comments"] = f"""WITH {_labelled(True)}, {q.BLANKED}
SELECT comment_id, user_name, original_text, cluster, sentimento, problema, size FROM blanked"""
_BLANK = f"""blank AS (SELECT * REPLACE (nullif(sentimento, {q.q(TAXONOMY.unknown_sentiment)}) AS sentimento,
  nullif(cluster, {q.q(TAXONOMY.unknown_label)}) AS cluster) FROM felt)"""
ORACLES["null_sentinels"] = f"WITH {_labelled()}, {_BLANK} SELECT comment_id, cluster, sentimento FROM blank"
for _name, _days in (("user_problem_mode_30d", 30), ("user_problem_mode_7d", WEEK)):
    ORACLES[_name] = f"""WITH {_labelled()}, {_BLANK}, {q.user_modes('blank', _days)}
SELECT comment_id, user_name, problema_30d FROM blank LEFT JOIN user_modes USING (user_name)"""
ORACLES["replay_problem_mode"] = f"""WITH {_labelled()}, {_BLANK}, {q.replayed('blank', REPLAY_START, REPLAY_END, WEEK)}
SELECT comment_id, user_name, strftime(interaction_date, '%Y-%m-%d') AS interaction_date, problema_30d FROM replayed"""
ORACLES["date_range"] = """WITH days AS (SELECT CAST(unnest(generate_series(DATE '2023-12-25', DATE '2024-02-04', INTERVAL 1 DAY)) AS DATE) AS day)
SELECT strftime(day, '%Y-%m-%d') AS day, count(event_id) AS n FROM days LEFT JOIN events ON CAST(ts AS DATE) = day GROUP BY 1"""

_FINISHED = f"""strftime(interaction_date, '%Y-%m-%d') AS interaction_date, user_name, url, content_type, original_text, cluster,
  sentimento, problema, problema_30d, {q.order_number('original_text')} AS order_number"""
ORACLES["classify_comments"] = f"""WITH {q.CLASSIFIED}, {q.user_modes('blanked', 30)}
SELECT {_FINISHED} FROM blanked LEFT JOIN user_modes USING (user_name)"""
ORACLES["classify_repeated"] = ORACLES["classify_comments"]
ORACLES["registry_classify"] = ORACLES["classify_trained"] = f"""WITH {q.SENTENCES}
SELECT original_text, {q.order_number('original_text')} AS order_number FROM cleaned GROUP BY original_text"""
ORACLES["replay_comments"] = f"""WITH {q.CLASSIFIED}, {q.replayed('blanked', '2024-01-20', '2024-02-20', 30)}
SELECT {_FINISHED} FROM replayed"""

# -- streams -------------------------------------------------------------------------------------

_INGESTED = f"WITH {q.SENTENCES} SELECT {_SENTENCE_COLUMNS}, reject_reason, text FROM cleaned"
for _name in ("stream_ingest", "stream_ingest_in_parts", "stream_ingest_in_runs"):
    ORACLES[_name] = _INGESTED
for _name in ("stream_classify", "stream_classify_in_parts", "stream_classify_in_runs"):
    ORACLES[_name] = ORACLES["classify_comments"]
ORACLES["stream_problem_mode"] = f"""WITH {_labelled()}, {_BLANK}, {q.rolling_modes('blank', WEEK)}
SELECT user_name, strftime(run, '%Y-%m-%d') AS run, problema_30d, n FROM rolling"""
ORACLES["stream_problem_counts"] = f"""WITH rows AS (
  SELECT 'user_' || user_id AS user_name, CAST(ts AS DATE) AS d, event_type AS problema FROM events WHERE event_type <> 'signup'),
spans AS (SELECT user_name, problema, d + CAST(unnest(range({WEEK + 1})) AS INTEGER) AS run FROM rows)
SELECT user_name, strftime(run, '%Y-%m-%d') AS run, problema, count(*) AS n FROM spans GROUP BY ALL"""
for _dialect in ("train", "infer", "replay"):
    ORACLES[f"csv_read_{_dialect}"] = f"""WITH {q.SENTENCES}
SELECT interaction_date, user_name, url, sha256(original_text) AS text_digest, sentence_idx, reject_reason, text FROM cleaned"""

assert NO_TEXT_IDS == 1_000_000_000  # as written out in suite.sql
