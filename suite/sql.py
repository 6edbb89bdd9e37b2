"""The same steps in DuckDB SQL, as named common table expressions."""

from __future__ import annotations

from collections.abc import Sequence

from recado.functions.stem import StemRule
from recado.functions.text import NO_LETTER
from suite.adapters import CENTROIDS, EVENT_LABELS, EVENT_TYPES, PROBLEM_OF
from suite.profile import TAXONOMY, TEST

WS = r"[\x09-\x0d\x1c-\x20\x{85}\p{Z}]"
NOT_WS = r"[^\x09-\x0d\x1c-\x20\x{85}\p{Z}]"


def q(x: object) -> str:
    if x is None:
        return "NULL"
    return "'" + str(x).replace("'", "''") + "'" if isinstance(x, str) else str(x)


def values(rows: Sequence[Sequence[object]], columns: str) -> str:
    body = ", ".join("(" + ", ".join(map(q, r)) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) t({columns})"


def listing(items: Sequence[str]) -> str:
    return "[" + ", ".join(map(q, items)) + "]"


def rx(text: str, pattern: str, new: str = "") -> str:
    return f"regexp_replace({text}, {q(pattern)}, {q(new)}, 'g')"


# -- scalar steps --------------------------------------------------------------------------------

def foreign_mention(x: str) -> str:
    return f"(starts_with({x}, '@') AND NOT contains({x}, {q('@' + TEST.brand)}))"


def name_first(x: str) -> str:
    pattern = rf"^[A-ZÀ-Ú][a-zà-ú]+({WS}|,)[A-ZÀ-Ú][a-zà-ú]{{1,15}}"
    return f"(regexp_matches({x}, {q(pattern)}) AND NOT contains({x}, {q(TEST.brand)}))"


def strip_handles(x: str) -> str:
    return rx(x, f"@{NOT_WS}+")


def strip_brand(x: str) -> str:
    return f"CASE WHEN starts_with({x}, {q(TEST.brand)}) THEN substr({x}, {len(TEST.brand) + 1}) ELSE {x} END"


def marks(x: str) -> str:
    x = rx(x, r"\.\.+", ".")
    x = rx(x, rf'{WS}([?.!"]({WS}|$))', r"\1")
    return f"replace({x}, ',', '.')"


def split_sentences(x: str) -> str:
    x = rx(x, rf"([.!?]){WS}+$", r"\1")
    return f"string_split({rx(x, rf'([.!?]){WS}+', chr(92) + '1' + chr(1))}, {q(chr(1))})"


def no_stops(x: str) -> str:
    words = f"string_split({rx(x, r'[^\p{L}\p{N}_]+', ' ')}, ' ')"
    stops = listing(TEST.all_stop_words())
    return (f"array_to_string(list_filter({words}, lambda w: NOT list_contains({stops}, w) "
            rf"AND NOT regexp_full_match(w, '\p{{N}}+')), ' ')")


def residue(x: str) -> str:
    x = rx(rx(rx(rx(x, " +", " "), f"^{WS}+"), "kk+"), r"r\$")
    return rx(rx(x, r"(?:\\n)+", ". "), r"(?:\\t)+", ". ")


def letters(x: str) -> str:
    return rx(x, "[^a-zA-ZÀ-ÿ ]+")


def words(x: str) -> str:
    return f"list_filter(string_split({rx(x, WS + '+', ' ')}, ' '), lambda w: w <> '')"


def n_words(x: str) -> str:
    return f"len({words(x)})"


def sized(x: str) -> str:
    return f"({n_words(x)} BETWEEN {TEST.lower_limit} AND {TEST.upper_limit})"


def lemmas(x: str) -> str:
    keys, vals = zip(*TEST.lemma_map().items(), strict=True)
    table = f"map({listing(keys)}, {listing(vals)})"
    return f"array_to_string(list_transform(string_split({x}, ' '), lambda w: coalesce({table}[w], w)), ' ')"


def accents(x: str) -> str:
    for old, new in (("ß", "ss"), ("æ", "ae"), ("Æ", "AE"), ("þ", "th"), ("Þ", "Th")):
        x = f"replace({x}, {q(old)}, {q(new)})"
    return f"strip_accents({x})"


def synonyms(x: str) -> str:
    for old, new in TEST.synonyms:
        x = f"replace({x}, {q(old)}, {q(new)})"
    return x


def any_of(x: str, terms: Sequence[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(term)})" for term in terms) + ")"


def useless(x: str) -> str:
    for pattern in TEST.useless:
        x = rx(x, pattern.replace(NO_LETTER, "[^A-Za-zÀ-ÿ]"), " ")
    return x


def collapse(x: str) -> str:
    return rx(x, " +", " ")


def order_number(x: str) -> str:
    return rf"nullif(regexp_extract(coalesce({x}, ''), '(\p{{Nd}}{{8,10}})', 1), '')"


def stem_step(x: str, rules: Sequence[StemRule]) -> str:
    cases = []
    for r in sorted(rules, key=lambda r: -len(r.suffix)):
        skip = f" AND {x} NOT IN ({', '.join(map(q, r.exceptions))})" if r.exceptions else ""
        cases.append(f"WHEN suffix({x}, {q(r.suffix)}) AND length({x}) >= {len(r.suffix) + r.min_stem}{skip} "
                     f"THEN left({x}, length({x}) - {len(r.suffix)}) || {q(r.replacement)}")
    return f"CASE {' '.join(cases)} ELSE {x} END"


def stem_ctes(words_from: str, column: str) -> str:
    """CTE `stems(w, stem)` over the distinct words of a query."""
    by_step = {s: [r for r in TEST.stem_rules if r.step == s] for s in dict.fromkeys(r.step for r in TEST.stem_rules)}
    ctes = [f"stem_0 AS (SELECT DISTINCT {column} AS w, {column} AS s FROM ({words_from}) AS source)"]
    for i, step in enumerate(("plural", "feminine", "augmentative", "adverb")):
        ctes.append(f"stem_{i + 1} AS (SELECT w, {stem_step('s', by_step[step])} AS s FROM stem_{i})")
    ctes.append(f"stem_5 AS (SELECT w, s, {stem_step('s', by_step['noun'])} AS noun FROM stem_4)")
    ctes.append(f"stem_6 AS (SELECT w, s, noun, {stem_step('s', by_step['verb'])} AS verb FROM stem_5)")
    ctes.append(f"stems AS MATERIALIZED (SELECT w, CASE WHEN noun <> s THEN noun WHEN verb <> s THEN verb "
                f"ELSE {stem_step('s', by_step['vowel'])} END AS stem FROM stem_6)")
    return ",\n".join(ctes)


# -- comments ------------------------------------------------------------------------------------

COMMENTS = """comments AS (
  SELECT comment_id, strftime(DATE '2024-01-01' + CAST((comment_id * 7) % 60 AS INTEGER), '%Y-%m-%d') AS interaction_date,
    CASE WHEN comment_id % 41 <> 0 THEN 'user_' || comment_id % 37 END AS user_name,
    CASE WHEN comment_id % 53 <> 0 THEN 'https://social.example/p/' || comment_id % 50 || '/c/' || comment_id END AS url,
    content_type,
    CASE WHEN comment_id % 23 = 0 THEN '@maria ' || text WHEN comment_id % 29 = 0 THEN '@erreth ' || text
         WHEN comment_id % 19 = 0 THEN 'Maria Souza, ' || text ELSE text END AS text
  FROM (SELECT doc_id AS comment_id, text, source AS content_type FROM documents
        UNION ALL SELECT 1000000000 + doc_id, NULL, 'label' FROM labels))"""

TEXTS = COMMENTS + ",\ntexts AS (SELECT comment_id, text FROM comments WHERE text IS NOT NULL)"


def post_path(x: str) -> str:
    parts = f"string_split(coalesce({x}, 'no_url'), '/')"
    return (f"replace(array_to_string(list_filter(list_slice({parts}, 1, len({parts}) - 1), lambda p: p <> ''), '/'), "
            "':/', '://')")


def post_query(x: str) -> str:
    parts = f"string_split(coalesce({x}, 'no_url'), '?')"
    return f"array_to_string(list_filter(list_slice({parts}, 1, len({parts}) - 1), lambda p: p <> ''), '/')"


DEDUPED = COMMENTS + """,
deduped AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY text, user_name ORDER BY interaction_date, comment_id) AS rn
  FROM comments WHERE text IS NOT NULL) WHERE rn = 1)"""

DATED = DEDUPED + f""",
posts AS (SELECT * EXCLUDE (url), {post_path('url')} AS url FROM deduped),
dated AS (SELECT *, min(interaction_date) OVER (PARTITION BY url) AS publish_date FROM posts)"""

SENTENCES = DATED + f""",
tagged AS MATERIALIZED (SELECT *, CASE WHEN {foreign_mention('text')} THEN 'mention' WHEN {name_first('text')} THEN 'name' END AS reason FROM dated),
lowered AS (SELECT *, lower(text) AS t_lower FROM tagged WHERE reason IS NULL),
handled AS (SELECT *, {strip_handles('t_lower')} AS t_handles FROM lowered),
branded AS (SELECT *, {strip_brand('t_handles')} AS t_brand FROM handled),
marked AS (SELECT *, {marks('t_brand')} AS t_marks FROM branded),
pieces AS (SELECT *, unnest({split_sentences('t_marks')}) AS t_sentences,
             generate_subscripts({split_sentences('t_marks')}, 1) - 1 AS sentence_idx FROM marked),
stopped AS (SELECT *, {no_stops('t_sentences')} AS t_stop_words FROM pieces),
resid AS (SELECT *, {residue('t_stop_words')} AS t_residue FROM stopped),
lettered AS (SELECT *, {letters('t_residue')} AS t_letters FROM resid),
medium AS (SELECT * FROM lettered WHERE {sized('t_letters')}),
lemmad AS (SELECT *, {lemmas('t_letters')} AS t_lemmas FROM medium),
plain AS (SELECT *, {accents('t_lemmas')} AS t_accents FROM lemmad),
synon AS (SELECT *, {synonyms('t_accents')} AS t_synonyms FROM plain),
judged AS MATERIALIZED (SELECT * EXCLUDE (reason), CASE WHEN NOT {any_of('t_synonyms', TEST.mandatory)} THEN 'mandatory'
             WHEN {any_of('t_synonyms', TEST.blacklist)} THEN 'blacklist' END AS reason FROM synon),
used AS MATERIALIZED (SELECT *, {useless('t_synonyms')} AS t_useless FROM judged WHERE reason IS NULL),
words AS MATERIALIZED (SELECT comment_id, sentence_idx, unnest({words('t_useless')}) AS w,
            generate_subscripts({words('t_useless')}, 1) AS pos FROM used),
{stem_ctes('SELECT w FROM words', 'w')},
stemmed AS (SELECT comment_id, sentence_idx, string_agg(stem, ' ' ORDER BY pos) AS t_stems
            FROM words JOIN stems USING (w) GROUP BY ALL),
final AS (SELECT used.*, coalesce(t_stems, '') AS t_final FROM used LEFT JOIN stemmed USING (comment_id, sentence_idx)),
cleaned AS (
  SELECT comment_id, interaction_date, user_name, url, content_type, publish_date, text AS original_text,
    sentence_idx, CASE WHEN t_final = '' THEN 'blank' END AS reject_reason, t_final AS text FROM final
  UNION ALL
  SELECT comment_id, interaction_date, user_name, url, content_type, publish_date, text,
    sentence_idx, reason, t_synonyms FROM judged WHERE reason IS NOT NULL
  UNION ALL
  SELECT comment_id, interaction_date, user_name, url, content_type, publish_date, text, -1, reason, text
  FROM tagged WHERE reason IS NOT NULL)"""

# -- events as sentences with a cluster ----------------------------------------------------------

_KIND = "CASE event_type " + " ".join(f"WHEN {q(e)} THEN {i}" for i, e in enumerate(EVENT_TYPES)) + " END"
_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def event_sentences(teams: bool = False) -> str:
    user = "CASE WHEN user_id % 17 <> 0 THEN 'user_' || user_id END"
    note = f"'note ' || {_K}"
    if teams:
        user = "CASE WHEN user_id % 15 <> 0 THEN 'team_' || user_id % 15 END"
        note = f"'note ' || {_K} // 4"
    return f"""sentences AS (
  SELECT event_id AS comment_id, 0 AS sentence_idx, {user} AS user_name, date_trunc('day', ts) AS interaction_date,
    'https://social.example/e/' || event_type AS url, event_type AS content_type, {note} AS original_text,
    {_KIND} * 3 + {_K} % 3 AS subclusters_id FROM events)"""


_LABEL = "CASE subclusters_id " + " ".join(f"WHEN {i} THEN {q(n)}" for i, n in enumerate(EVENT_LABELS) if n) + " END"
_PROBLEM = "CASE cluster " + " ".join(f"WHEN {q(n)} THEN {q(p)}" for n, p in PROBLEM_OF.items()) + " END"

EVENT_LOOKUP = f"""lookup AS (
  SELECT *, {_PROBLEM} AS problema FROM (
    SELECT subclusters_id, count(*) AS size, {_LABEL} AS cluster FROM sentences
    WHERE subclusters_id < {len(EVENT_LABELS)} GROUP BY subclusters_id))"""

FIXED_LOOKUP = "lookup AS (" + values(
    [(n, name, PROBLEM_OF.get(name), 1000 - 37 * n % 400) for n, name in enumerate(EVENT_LABELS)],
    "subclusters_id, cluster, problema, size") + ")"

_SENTIMENT = (f"CASE WHEN cluster IS NULL THEN {q(TAXONOMY.unknown_sentiment)} ELSE CASE cluster "
              + " ".join(f"WHEN {q(n)} THEN {q(s)}" for n, s in TAXONOMY.label_sentiments()) + " END END")

_SEVERITY = "CASE sentimento " + " ".join(f"WHEN {q(s)} THEN {i}" for i, s in enumerate(TAXONOMY.severity)) + " END"


def sentiment(source: str) -> str:
    return f"felt AS (SELECT *, {_SENTIMENT} AS sentimento FROM {source})"


MODES = """per_label AS (
  SELECT user_name, original_text, sentimento, cluster, count(*) AS n, max(size) AS size FROM felt
  WHERE user_name IS NOT NULL AND original_text IS NOT NULL AND sentimento IS NOT NULL GROUP BY ALL),
top_label AS (SELECT user_name, original_text, sentimento, max(n) AS top_n FROM per_label WHERE cluster IS NOT NULL GROUP BY ALL),
modes AS (
  SELECT user_name, original_text, sentimento, CASE WHEN count(*) FILTER (WHERE n = top_n AND cluster IS NOT NULL) > 1
    THEN first(cluster ORDER BY size DESC NULLS LAST, cluster DESC NULLS LAST)
    ELSE min(cluster) FILTER (WHERE n = top_n) END AS cluster_mode, sum(n) AS n_rows
  FROM per_label LEFT JOIN top_label USING (user_name, original_text, sentimento) GROUP BY ALL)"""

APPLIED = MODES + """,
applied AS (SELECT felt.* EXCLUDE (cluster), cluster_mode AS cluster FROM felt
            LEFT JOIN modes USING (user_name, original_text, sentimento))"""

CHOSEN = APPLIED + f""",
chosen AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY original_text
    ORDER BY {_SEVERITY} DESC NULLS FIRST, size DESC NULLS FIRST, comment_id NULLS FIRST, sentence_idx NULLS FIRST) AS rn
  FROM applied) WHERE rn = 1)"""

BLANKED = CHOSEN + f""",
blanked AS (SELECT * REPLACE (nullif(sentimento, {q(TAXONOMY.unknown_sentiment)}) AS sentimento,
                             nullif(cluster, {q(TAXONOMY.unknown_label)}) AS cluster) FROM chosen)"""


def user_modes(source: str, days: int) -> str:
    """CTE `user_modes(user_name, problema_30d)`."""
    return f"""severe AS (SELECT *, coalesce({_SEVERITY}, 1000) AS sev FROM {source} WHERE user_name IS NOT NULL),
lasts AS (SELECT user_name, max(interaction_date) AS last FROM severe GROUP BY 1),
recent AS (SELECT user_name, problema, count(*) AS n FROM severe JOIN lasts USING (user_name)
           WHERE problema IS NOT NULL AND interaction_date >= last - to_days({days}) GROUP BY ALL),
ranked AS (SELECT *, max(n) OVER (PARTITION BY user_name) AS top_n FROM recent),
tops AS (SELECT user_name, count(*) AS n_modes, min(problema) AS mode FROM ranked WHERE n = top_n GROUP BY 1),
worst AS (SELECT user_name, problema AS worst_problem FROM severe
          QUALIFY row_number() OVER (PARTITION BY user_name ORDER BY sev DESC, interaction_date DESC NULLS LAST,
                                     comment_id DESC, sentence_idx DESC) = 1),
user_modes AS (SELECT user_name, CASE WHEN n_modes > 1 THEN worst_problem ELSE mode END AS problema_30d
               FROM worst LEFT JOIN tops USING (user_name))"""


def replayed(source: str, start: str, end: str, days: int) -> str:
    """CTE `replayed`: a run per day, the last one to reach a row wins."""
    return f"""severe AS (SELECT *, coalesce({_SEVERITY}, 1000) AS sev, CAST(interaction_date AS DATE) AS d FROM {source}),
runs AS (SELECT CAST(unnest(generate_series(DATE '{start}', DATE '{end}' - 1, INTERVAL 1 DAY)) AS DATE) AS run),
inside AS (SELECT run, severe.* FROM runs JOIN severe ON d BETWEEN run - {days} AND run WHERE user_name IS NOT NULL),
counts AS (SELECT run, user_name, problema, count(*) AS n FROM inside WHERE problema IS NOT NULL GROUP BY ALL),
ranked AS (SELECT *, max(n) OVER (PARTITION BY run, user_name) AS top_n FROM counts),
tops AS (SELECT run, user_name, count(*) AS n_modes, min(problema) AS mode FROM ranked WHERE n = top_n GROUP BY ALL),
worst AS (SELECT run, user_name, problema AS worst_problem FROM inside
          QUALIFY row_number() OVER (PARTITION BY run, user_name
                                     ORDER BY sev DESC, d DESC, comment_id DESC, sentence_idx DESC) = 1),
results AS (SELECT run, user_name, CASE WHEN n_modes > 1 THEN worst_problem ELSE mode END AS problema_30d
            FROM worst LEFT JOIN tops USING (run, user_name)),
final_run AS (SELECT comment_id, sentence_idx, max(run) AS run FROM inside GROUP BY ALL),
replayed AS (SELECT s.*, r.problema_30d FROM severe s
             LEFT JOIN final_run f ON f.comment_id = s.comment_id AND f.sentence_idx IS NOT DISTINCT FROM s.sentence_idx
             LEFT JOIN results r ON r.run = f.run AND r.user_name = s.user_name)"""


def rolling_modes(source: str, days: int) -> str:
    """CTE `rolling`: the most frequent problem of each user's span, for every day on which one ends."""
    return f"""severe AS (SELECT *, coalesce({_SEVERITY}, 1000) AS sev, CAST(interaction_date AS DATE) AS d FROM {source}
           WHERE user_name IS NOT NULL AND interaction_date IS NOT NULL),
inside AS (SELECT d + CAST(unnest(range({days} + 1)) AS INTEGER) AS run, * FROM severe),
counts AS (SELECT run, user_name, problema, count(*) AS n FROM inside WHERE problema IS NOT NULL GROUP BY ALL),
ranked AS (SELECT *, max(n) OVER (PARTITION BY run, user_name) AS top_n FROM counts),
tops AS (SELECT run, user_name, count(*) AS n_modes, min(problema) AS mode FROM ranked WHERE n = top_n GROUP BY ALL),
worst AS (SELECT run, user_name, problema AS worst_problem, count(*) OVER (PARTITION BY run, user_name) AS n FROM inside
          QUALIFY row_number() OVER (PARTITION BY run, user_name
                                     ORDER BY sev DESC, d DESC, comment_id DESC, sentence_idx DESC) = 1),
rolling AS (SELECT run, user_name, CASE WHEN n_modes > 1 THEN worst_problem ELSE mode END AS problema_30d, n
            FROM worst LEFT JOIN tops USING (run, user_name))"""


NEAREST = f"""centroids AS ({values([(i, *c) for i, c in CENTROIDS], 'subclusters_id, c1, c2, c3')}),
kept AS (SELECT * FROM cleaned WHERE reject_reason IS NULL),
measured AS (SELECT comment_id, sentence_idx, {n_words('text')} AS f1, length(text) AS f2,
               length(text) - length(replace(text, 'e', '')) AS f3 FROM kept),
nearest AS (SELECT comment_id, sentence_idx, m.subclusters_id FROM (
  SELECT comment_id, sentence_idx, subclusters_id, row_number() OVER (PARTITION BY comment_id, sentence_idx
    ORDER BY round((f1 - c1) * (f1 - c1) + (f2 - c2) * (f2 - c2) + (f3 - c3) * (f3 - c3), 6), subclusters_id) AS rn
  FROM measured CROSS JOIN centroids) m WHERE rn = 1)"""

CLASSIFIED = f"""{SENTENCES},
{NEAREST},
{FIXED_LOOKUP},
sentences AS (
  SELECT k.*, l.cluster, l.problema, l.size FROM kept k JOIN nearest USING (comment_id, sentence_idx) JOIN lookup l USING (subclusters_id)
  UNION ALL SELECT *, NULL, NULL, NULL FROM (SELECT * REPLACE (CASE WHEN sentence_idx >= 0 THEN sentence_idx END AS sentence_idx)
                                             FROM cleaned WHERE reject_reason IS NOT NULL)),
dated_sentences AS (SELECT * REPLACE (CAST(interaction_date AS TIMESTAMP) AS interaction_date) FROM sentences),
{sentiment('dated_sentences')},
{BLANKED}"""
