"""The queries in DuckDB's SQL. Regular expressions are without lookaround, which it lacks."""

from __future__ import annotations

from chapterloom.plans.oracle_tables import CTES, sql

WS = r"[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def section(tag: str, c: str = "raw") -> str:
    pattern = f"(?s)<{tag}>(.*?)</{tag}>"
    return f"CASE WHEN regexp_matches({c}, '{pattern}') THEN {strip(f'regexp_extract({c}, {chr(39)}{pattern}{chr(39)}, 1)')} END"


TOKEN = r"\[\[\s*[Gg]\s*0*([0-9]+)\s*\]\]"
NEW = r"\[\[NEW:\s*([^|\]]+?)\s*(?:\|\s*([^\]]*?)\s*)?\]\]"

# The terms of lines (slug, chapter, pos, line): fields, then what is wrong.
PARSED = f"""SELECT slug, chapter, pos, f[1] AS korean, f[2] AS english, f[3] AS category, coalesce(f[4], '') AS note,
  CASE WHEN len(f) > 4 AND f[5] <> '' THEN lower(f[5]) NOT IN ('no', 'false', '0', 'soft') ELSE true END AS enforce,
  CASE WHEN len(f) < 3 THEN 'too few fields' WHEN f[1] = '' THEN 'blank korean' WHEN f[2] = '' THEN 'blank english'
    WHEN f[3] NOT IN ('person', 'place', 'organization', 'technique', 'rank_title', 'item', 'creature', 'other') THEN 'unknown category' ELSE '' END AS error
  FROM (SELECT slug, chapter, pos, list_transform(string_split(line, '|'), lambda x: {strip('x')}) AS f FROM lines)"""
LINES = "SELECT slug, chapter, generate_subscripts(l, 1) - 1 AS pos, replace(unnest(l), '`', '') AS line FROM (SELECT slug, chapter, string_split(block, chr(10)) AS l FROM term_lines)"

# Replies with sections, the first faulty line and the error of a mining reply.
REPLY = f"""SELECT slug, chapter, {section('translation')} AS translation, {section('chapter_summary')} AS summary, {section('new_glossary_terms')} AS block FROM replies"""
FAULT = "SELECT slug, chapter, count(*) AS n, arg_min(error, pos) FILTER (error <> '') AS fault FROM parsed GROUP BY slug, chapter"
MINED_OK = """SELECT r.*, CASE WHEN coalesce(summary, '') = '' THEN 'no chapter_summary' WHEN block IS NULL THEN 'no new_glossary_terms'
  WHEN starts_with(upper(block), 'NONE') AND NOT contains(block, '|') THEN '' ELSE coalesce(fault, '') END AS mining_error,
  CASE WHEN starts_with(upper(coalesce(block, '')), 'NONE') AND NOT contains(block, '|') THEN 0 ELSE coalesce(n, 0) END AS n
  FROM reply r LEFT JOIN fault USING (slug, chapter)"""
TERM_TEXT = "string_agg(coalesce(korean, '') || '|' || coalesce(english, '') || '|' || coalesce(category, '') || '|' || note || '|' || CAST(enforce AS VARCHAR), ';' ORDER BY pos)"
REPLY_TABLES = {"lines": LINES, "parsed": PARSED, "fault": FAULT, "reply": REPLY, "mining": MINED_OK, "texts": f"SELECT slug, chapter, {TERM_TEXT} AS terms FROM parsed GROUP BY slug, chapter"}
TERMS = {**REPLY_TABLES, "terms": "SELECT p.* FROM parsed p JOIN mining m USING (slug, chapter) WHERE m.mining_error = '' AND m.n > 0"}
ENTITIES = f"""SELECT slug, chapter, generate_subscripts(k, 1) - 1 AS pos, {strip('unnest(k)')} AS korean, {strip("coalesce(unnest(e), '')")} AS english
  FROM (SELECT slug, chapter, regexp_extract_all(raw, '{NEW}', 1) AS k, regexp_extract_all(raw, '{NEW}', 2) AS e FROM tokened)"""


def appended(rows: str, order: str) -> dict[str, str]:
    """Glossary and what ``rows`` (slug, korean, english, category, note, enforce and the order's columns) adds."""
    return {
        "fresh": f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY slug, korean ORDER BY {order}, english, category, note, enforce) AS k FROM ({rows}) r WHERE (slug, korean) NOT IN (SELECT slug, korean FROM glossary)) WHERE k = 1",
        "added": f"""SELECT f.slug, CAST(coalesce(last, 0) + row_number() OVER (PARTITION BY f.slug ORDER BY {order}, korean) AS INT) AS token_id, korean, english, category, note, enforce
          FROM fresh f LEFT JOIN (SELECT slug, max(token_id) AS last FROM glossary GROUP BY slug) g ON f.slug = g.slug""",
        "whole": "SELECT slug, token_id, korean, english, category, note, enforce FROM glossary UNION ALL SELECT * FROM added",
    }


ENTITY_TERMS = "SELECT slug, chapter, pos, korean, english, 'other' AS category, 'reported by the translator' AS note, true AS enforce FROM entities WHERE korean <> '' AND english <> ''"
GOOD_TERMS = "SELECT slug, chapter, pos, korean, english, category, note, enforce FROM terms"

CLEANED = f"""SELECT slug, chapter, pos, korean, CASE WHEN fixed THEN e ELSE english END AS english, category, note, fixed OR enforce AS enforce, fixed
  FROM (SELECT *, e <> '' AND e <> english AS fixed FROM (SELECT *, {strip("string_split(string_split(english, '/')[1], '(')[1]")} AS e FROM mined))"""
KEY = r"regexp_replace(regexp_replace(korean, '\([^)]*\)|（[^）]*）', '', 'g'), '\s+', '', 'g')"

CHECKED = """SELECT c.slug, c.chapter, c.chapter % 10 = 9 AS missing, CASE WHEN c.chapter % 10 <> 9 THEN count(s.token_id) END AS present,
  CASE WHEN c.chapter % 10 <> 9 THEN count(s.token_id) FILTER (s.ok) END AS ok,
  CASE WHEN c.chapter % 10 <> 9 THEN coalesce(string_agg(s.token_id, ';' ORDER BY s.token_id) FILTER (NOT s.ok), '') END AS violations
  FROM docs c LEFT JOIN scored s USING (slug, chapter) GROUP BY c.slug, c.chapter"""
PERCENT = "CASE WHEN sum(present) > 0 THEN CAST(round_even(100 * sum(ok) / sum(present), 0) AS INT) ELSE 0 END"

# Substitution: numbered tokens by pieces; NEW and labelled ones by capture; the last pass by pieces too.
_SPLIT = "list_transform(range(1, len(b) + 1), lambda i: b[i] || coalesce({0}, ''))"
SUBSTITUTED = {
    "s1": rf"SELECT slug, chapter, regexp_replace(raw, '\[{{2,}}(\s*[Gg]\s*0*[0-9]+\s*)\]{{2,}}', '[[\1]]', 'g') AS x FROM {{0}}",
    "s2": f"""SELECT slug, chapter, array_to_string({_SPLIT.format("coalesce(ids[TRY_CAST(n[i] AS INT)], t[i])")}, '') AS x
      FROM (SELECT s1.slug, chapter, ids, regexp_split_to_array(x, '{TOKEN.replace('([0-9]+)', '[0-9]+')}') AS b, regexp_extract_all(x, '{TOKEN}') AS t, regexp_extract_all(x, '{TOKEN}', 1) AS n FROM s1 LEFT JOIN book USING (slug))""",
    "s3": r"""SELECT slug, chapter, regexp_replace(regexp_replace(x, '\[\[NEW:\s*[^|\]]+?\s*\|\s*([^\]]*?[^\]\s])\s*\]\]', '\1', 'g'), '\[\[[^\[\]]*\|\s*([^\[\]|]+?)\s*\]\]', '\1', 'g') AS x FROM s2""",
    "s4": rf"""SELECT slug, chapter, array_to_string({_SPLIT.format("CASE WHEN starts_with(t[i], '[[NEW:') OR regexp_matches(t[i], '^.{2}[ ]*[Gg][ ]*0*[0-9]') THEN t[i] ELSE substr(t[i], 3, length(t[i]) - 4) END")}, '') AS body
      FROM (SELECT slug, chapter, regexp_split_to_array(x, '\[\[[^\[\]]*?\]\]') AS b, regexp_extract_all(x, '\[\[[^\[\]]*?\]\]') AS t FROM s3)""",
    "gate": r"SELECT slug, chapter, body, regexp_extract_all(body, '\[\[[^\]]*\]\]') AS leaked FROM s4",
}


def substituted(table: str) -> dict[str, str]:
    return {k: v.replace("{0}", table) if k == "s1" else v for k, v in SUBSTITUTED.items()}


INVALID = f"""SELECT t.slug, t.chapter, list_filter(list_transform(range(1, len(tk) + 1), lambda i: CASE WHEN coalesce(TRY_CAST(n[i] AS INT) BETWEEN 1 AND coalesce(n_terms, 0), false) THEN NULL ELSE tk[i] END), lambda x: x IS NOT NULL) AS invalid
  FROM (SELECT slug, chapter, regexp_extract_all(raw, '{TOKEN}') AS tk, regexp_extract_all(raw, '{TOKEN}', 1) AS n FROM {{0}}) t LEFT JOIN book USING (slug)"""

PARTICLE_END = CTES["present"].split("regexp_escape(g.korean) || '")[1].rsplit("')", 1)[0]
# A term's longer terms are taken out of the text one after another, in the order of ids.
FORGOTTEN = {
    "overs": "SELECT g.slug, g.token_id, g.korean, coalesce(list(o.korean ORDER BY o.token_id) FILTER (o.korean IS NOT NULL), []) AS over FROM glossary g LEFT JOIN glossary o ON g.slug = o.slug AND g.korean <> o.korean AND contains(o.korean, g.korean) WHERE g.enforce GROUP BY g.slug, g.token_id, g.korean",
    "forgot": rf"""SELECT slug, chapter, token_id, korean FROM (
      SELECT c.slug, c.chapter, o.token_id, o.korean, list_reduce(list_prepend(c.text, o.over), lambda acc, x: replace(acc, x, '')) AS masked
      FROM chapters c JOIN overs o USING (slug) JOIN {{0}} t USING (slug, chapter)
      WHERE contains(c.text, o.korean) AND NOT list_contains(list_transform(regexp_extract_all(t.raw, '{TOKEN}', 1), lambda x: TRY_CAST(x AS INT)), o.token_id)
    ) WHERE regexp_matches(masked, '(^|[^가-힣])' || regexp_escape(korean) || '{PARTICLE_END}')""",
}


def defects(table: str = "tokened") -> dict[str, str]:
    """(slug, chapter, forgotten, invalid, new, needs_repair) of a table of replies."""
    return {
        "overs": FORGOTTEN["overs"],
        "forgot": FORGOTTEN["forgot"].replace("{0}", table),
        "bad": INVALID.replace("{0}", table),
        "defect": f"""SELECT t.slug, t.chapter, CAST(coalesce(f, 0) AS INT) AS forgotten, CAST(len(invalid) AS INT) AS invalid, CAST(len(regexp_extract_all(raw, '{NEW}')) AS INT) AS new,
          coalesce(f, 0) > 0 OR len(invalid) > 0 AS needs_repair
          FROM {table} t JOIN bad USING (slug, chapter) LEFT JOIN (SELECT slug, chapter, count(*) AS f FROM forgot GROUP BY slug, chapter) USING (slug, chapter)""",
    }


TABLE_LINE = "rtrim(korean || ' | ' || english || ' | ' || category || ' | ' || note, ' |')"
BLOCK = f"""SELECT slug, '# Glossary'
  || coalesce(chr(10) || chr(10) || '## Fixed tokens' || chr(10) || 'Write the token for each of these terms.' || chr(10) || chr(10) || 'korean | token' || chr(10)
    || string_agg(korean || ' | [[G' || token_id || ']]' || CASE WHEN note <> '' THEN '  (' || note || ')' ELSE '' END, chr(10) ORDER BY token_id) FILTER (enforce), '')
  || chr(10) || chr(10) || '## Other names' || chr(10) || 'Write [[NEW:term|rendering]] for every other name.'
  || coalesce(chr(10) || chr(10) || '## Renderings' || chr(10) || 'korean | english | category | note' || chr(10) || string_agg({TABLE_LINE}, chr(10) ORDER BY token_id) FILTER (NOT enforce), '') AS block
  FROM glossary GROUP BY slug"""


def window_of(width: int) -> str:
    return f"""SELECT s.slug, s.chapter, list(p.chapter ORDER BY p.chapter) FILTER (p.chapter IS NOT NULL) AS cs, coalesce(string_agg('Ch.' || p.chapter || ': ' || p.summary, chr(10) ORDER BY p.chapter), '') AS lines,
      coalesce(string_agg(p.chapter || '|' || p.summary, ';' ORDER BY p.chapter), '') AS prior
      FROM summaries s LEFT JOIN summaries p ON p.slug = s.slug AND p.chapter BETWEEN s.chapter - {width} AND s.chapter - 1 AND p.chapter >= 1 AND p.summary IS NOT NULL GROUP BY s.slug, s.chapter"""


# The story as of the last due chapter before that of c.
ARC = "(SELECT arg_max(x.arc, x.chapter) FROM arcs x WHERE x.slug = c.slug AND x.chapter < c.chapter AND x.arc IS NOT NULL)"


def message(arc: str, text: str = "c.text") -> str:
    body = strip(text)
    return f"""CASE WHEN {body} <> '' THEN {arc} || CASE WHEN w.lines <> '' THEN '<previous_chapter_summaries>' || chr(10) || w.lines || chr(10) || '</previous_chapter_summaries>' || chr(10) || chr(10) ELSE '' END
      || '<chapter>' || chr(10) || {body} || chr(10) || '</chapter>' END"""


JUDGE_WORD = r"(?i)\b(A|B|tie)\b"


def verdict(c: str) -> str:
    word = f"regexp_extract({c}, '{JUDGE_WORD}', 1)"
    return f"CASE WHEN lower({word}) = 'tie' THEN 'tie' WHEN {word} <> '' THEN upper({word}) END"


JUDGED = f"""SELECT chapter, pair, {verdict(section('overall_winner'))} AS overall, coalesce({section('rationale')}, '') AS rationale,
  {" || ',' || ".join(f"coalesce({verdict(section(x))}, '?')" for x in ('accuracy', 'naturalness', 'voice', 'terminology', 'formatting'))} AS dimensions,
  CASE WHEN coalesce({section('overall_winner')}, '') = '' THEN 'no overall_winner' WHEN {verdict(section('overall_winner'))} IS NULL THEN 'no verdict' ELSE '' END AS parse_error
  FROM verdict_replies"""

# The last three summaries that there are before each chapter.
LAST_THREE = """SELECT s.slug, s.chapter, coalesce(string_agg(p.chapter, ';' ORDER BY p.chapter) FILTER (p.k <= 3), '') AS prior
  FROM summaries s LEFT JOIN LATERAL (SELECT q.chapter, row_number() OVER (ORDER BY q.chapter DESC) AS k FROM summaries q WHERE q.slug = s.slug AND q.chapter < s.chapter AND q.summary IS NOT NULL) p ON true
  GROUP BY s.slug, s.chapter"""

# Which of the terms that stand in a chapter its gated text has.
JUDGED_TERMS = {
    "said": "SELECT slug, chapter, lower(body) AS low, list_distinct(regexp_split_to_array(lower(body), '[^0-9a-z-]+')) AS words FROM gate",
    "judged_terms": """SELECT p.slug, p.chapter, p.token_id, p.korean, contains(low, lower(p.english)) OR (len(p.wanted) > 0 AND len(list_filter(p.wanted, lambda w: NOT list_contains(words, w))) = 0) AS ok
      FROM (SELECT *, list_filter(list_distinct(regexp_split_to_array(lower(english), '[^0-9a-z-]+')), lambda w: w NOT IN ('', 'the', 'of', 'a', 'an', 'and', 's')) AS wanted FROM present) p JOIN said USING (slug, chapter)""",
}

SQL: dict[str, str] = {
    "slice_chapters": sql(
        rf"""SELECT slug, CAST(row_number() OVER (PARTITION BY slug ORDER BY k) AS INT) AS chapter, length(body) AS n_chars, md5(body) AS digest FROM (
          SELECT slug, min(i) AS k, rtrim(string_agg(line, chr(10) ORDER BY i), ' ' || chr(9) || chr(10) || chr(13)) || chr(10) AS body FROM (
            SELECT slug, i, line, count(*) FILTER (head) OVER (PARTITION BY slug ORDER BY i) AS part FROM (
              SELECT slug, i, line, regexp_matches(line, '^\d+화(\s|$)') AS head FROM (SELECT slug, generate_subscripts(l, 1) AS i, unnest(l) AS line FROM (SELECT slug, string_split(text, chr(10)) AS l FROM novels)))
          ) WHERE part > 0 GROUP BY slug, part)""",
        "novels",
    ),
    "short_novels": sql(
        r"SELECT slug, count(*) FILTER (regexp_matches(line, '^\d+화(\s|$)')) AS found FROM (SELECT slug, unnest(string_split(text, chr(10))) AS line FROM novels) GROUP BY slug HAVING found < 45", "novels"
    ),
    "validate_chapters": sql(f"SELECT slug, chapter, CASE WHEN chapter % 7 = 0 OR {strip('text')} = '' THEN 'blank' ELSE 'ok' END AS status FROM chapters", "chapters"),
    "load_glossary": sql("SELECT *, '' AS reason FROM glossary", "glossary"),
    "load_context": sql("SELECT slug, '' AS arc_summary, chapter, summary FROM summaries WHERE summary IS NOT NULL", "summaries"),
    "ingest_results": sql(
        f"SELECT c.slug, c.chapter, CASE WHEN c.chapter % 6 = 1 THEN 'missing' WHEN c.chapter % 9 = 2 THEN 'error' ELSE 'ok' END AS status, CASE WHEN c.chapter % 6 <> 1 THEN md5(r.raw) END AS raw FROM chapters c JOIN replies r USING (slug, chapter) WHERE {strip('c.text')} <> ''",
        "chapters", "replies",
    ),
    "token_map": sql("SELECT slug, CAST(count(*) AS INT) AS n, string_agg(token_id || '=' || english, ';' ORDER BY token_id) AS ids FROM glossary GROUP BY slug", "glossary"),
    "call_log": sql("SELECT tag, model, count(*) AS calls, CAST(sum(input_tokens) AS BIGINT) AS input_tokens, round(sum(round(cost_usd, 6)), 6) AS cost_usd FROM costed GROUP BY tag, model", "costed"),
    "deliverable": sql(
        f"""SELECT name, length(text) AS n_chars, md5(text) AS digest FROM (
          SELECT slug || CASE WHEN bool_or(chapter % 50 = 7) THEN '_INCOMPLETE' ELSE '' END AS name,
            string_agg(string_split(source, chr(10))[1] || chr(10) || chr(10) || CASE WHEN chapter % 50 = 7 THEN '[chapter withheld: needs a human]' ELSE {strip('raw')} END || chr(10), chr(10) || chr(10) || chr(10) ORDER BY chapter) AS text
          FROM (SELECT slug, chapter, c.text AS source, raw FROM chapters c JOIN tokened USING (slug, chapter)) GROUP BY slug)""",
        "chapters", "tokened",
    ),
    "review_outputs": sql(
        f"SELECT 'u4' AS experiment, 'm' || (chapter % 3) AS variant, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM docs WHERE chapter % 8 <> 0 AND {strip('text')} <> '' GROUP BY ALL", "docs"
    ),
    "extract_sections": sql(f"SELECT slug, chapter, md5({section('translation')}) AS translation, {section('chapter_summary')} AS chapter_summary, true AS no_absent FROM replies", "replies"),
    "parse_term_lines": sql(
        "SELECT slug, chapter, pos, CASE WHEN error = '' THEN korean END AS korean, CASE WHEN error = '' THEN english END AS english, CASE WHEN error = '' THEN category END AS category, CASE WHEN error = '' THEN note END AS note, CASE WHEN error = '' THEN CAST(enforce AS VARCHAR) END AS enforce, error FROM parsed",
        "term_lines", more={"lines": LINES, "parsed": PARSED},
    ),
    "parse_terms_block": sql(
        f"SELECT slug, chapter, CASE WHEN chapter % 7 = 2 THEN '' ELSE {TERM_TEXT} END AS terms, CAST(CASE WHEN chapter % 7 = 2 THEN 0 ELSE count(*) FILTER (error <> '') END AS INT) AS n_bad FROM parsed GROUP BY slug, chapter",
        "term_lines", more={"lines": LINES, "parsed": PARSED},
    ),
    "parse_translations": sql(
        "SELECT slug, chapter, e AS parse_error, md5(CASE WHEN translation <> '' THEN translation END) AS translation, CASE WHEN summary <> '' THEN summary END AS chapter_summary, CASE WHEN e = '' THEN CASE WHEN n > 0 THEN terms ELSE '' END END AS terms FROM (SELECT *, CASE WHEN coalesce(translation, '') = '' THEN 'no translation' ELSE mining_error END AS e FROM mining) LEFT JOIN texts USING (slug, chapter)",
        "replies", more=REPLY_TABLES,
    ),
    "parse_mining": sql(
        "SELECT slug, chapter, mining_error AS parse_error, CASE WHEN summary <> '' THEN summary END AS chapter_summary, CASE WHEN mining_error = '' THEN CASE WHEN n > 0 THEN terms ELSE '' END END AS terms FROM mining LEFT JOIN texts USING (slug, chapter)",
        "replies", more=REPLY_TABLES,
    ),
    "parse_single_section": sql(
        "SELECT slug, chapter, md5(CASE WHEN translation <> '' THEN translation END) AS body, CASE WHEN coalesce(translation, '') = '' THEN 'no translation' ELSE '' END AS parse_error FROM reply", "replies", more={"reply": REPLY}
    ),
    "parse_json_replies": sql(
        f"""SELECT slug, chapter, e AS parse_error, CASE WHEN e = '' THEN md5({strip('text')}) END AS translation, CASE WHEN e = '' THEN '검성|Sword Saint|person|n|true' END AS terms, CASE WHEN e = '' THEN 'Ch ' || chapter END AS chapter_summary FROM (
          SELECT slug, chapter, text, CASE chapter % 9 WHEN 0 THEN 'bad translation' WHEN 1 THEN 'missing keys' WHEN 2 THEN 'no object' WHEN 3 THEN 'no json' WHEN 5 THEN 'too few fields' WHEN 6 THEN 'bad chapter_summary'
            ELSE CASE WHEN {strip('text')} = '' THEN 'bad translation' WHEN chapter % 5 = 0 THEN 'blank english' WHEN chapter % 7 = 0 THEN 'unknown category' ELSE '' END END AS e FROM docs)""",
        "docs",
    ),
    "parse_consolidated": sql(
        "SELECT slug, CAST(row_number() OVER (PARTITION BY slug ORDER BY chapter, pos) - 1 AS INT) AS pos, korean, english, category, note, enforce FROM parsed WHERE error = ''", "term_lines", more={"lines": LINES, "parsed": PARSED}
    ),
    "consolidated_drops": sql(
        "SELECT slug, CAST(count(*) AS INT) AS lines, CAST(count(*) FILTER (error <> '') AS INT) AS dropped FROM parsed GROUP BY slug", "term_lines", more={"lines": LINES, "parsed": PARSED}
    ),
    "parse_judge": sql("SELECT * FROM judged", "verdict_replies", more={"judged": JUDGED}),
    "validate_terms": sql("SELECT slug, CASE WHEN chapter % 5 = 0 THEN 'blank korean' WHEN chapter % 7 = 0 THEN 'unknown category' ELSE '' END AS reason, count(*) AS n FROM mined GROUP BY ALL", "mined"),
    "normalize_keys": sql(f"SELECT slug, chapter, pos, {KEY} AS key FROM mined", "mined"),
    "clean_terms": sql("SELECT slug, chapter, pos, english, enforce, fixed FROM cleaned", "mined", more={"cleaned": CLEANED}),
    "merge_terms": sql(
        """SELECT slug, CAST(row_number() OVER (PARTITION BY slug ORDER BY c0, p0) AS INT) AS token_id, CASE WHEN plain THEN key ELSE k0 END AS korean, english, category, note, true AS enforce FROM (
          SELECT slug, key, english, category, note, row_number() OVER (PARTITION BY slug, key ORDER BY votes DESC, chapter, pos) AS r,
            bool_or(korean = key) OVER (PARTITION BY slug, key) AS plain, first_value(korean) OVER w AS k0, first_value(chapter) OVER w AS c0, first_value(pos) OVER w AS p0
          FROM (SELECT *, count(*) OVER (PARTITION BY slug, key, english) AS votes FROM keyed) WINDOW w AS (PARTITION BY slug, key ORDER BY chapter, pos)
        ) WHERE r = 1""",
        "mined", more={"cleaned": CLEANED, "keyed": f"SELECT *, {KEY} AS key FROM cleaned"},
    ),
    "append_terms": sql("SELECT * FROM whole", "glossary", "mined", more=appended("SELECT * FROM mined", "chapter, pos")),
    "fold_new_entities": sql("SELECT * FROM whole", "glossary", "tokened", more={"entities": ENTITIES, **appended(ENTITY_TERMS, "chapter, pos")}),
    "fold_reported_terms": sql("SELECT * FROM whole", "glossary", "replies", more={**TERMS, **appended(GOOD_TERMS, "chapter, pos")}),
    "fold_back": sql(
        "SELECT * FROM whole", "glossary", "replies", more={**TERMS, "entities": ENTITIES, **appended(f"SELECT 0 AS priority, * FROM ({ENTITY_TERMS}) UNION ALL SELECT 1, * FROM ({GOOD_TERMS})", "priority, chapter, pos")}
    ),
    "glossary_stats": sql("SELECT slug, count(*) AS n_terms, count(*) FILTER (enforce) AS n_enforce, count(*) FILTER (NOT enforce) AS n_soft FROM glossary GROUP BY slug", "glossary"),
    "glossary_growth": sql(
        """SELECT slug, chapter, reported, added, CAST(sum(added) OVER (PARTITION BY slug ORDER BY chapter) AS BIGINT) AS size FROM (
          SELECT slug, chapter, count(*) AS reported, count(DISTINCT korean) FILTER (chapter = first) AS added FROM (SELECT *, min(chapter) OVER (PARTITION BY slug, korean) AS first FROM mined) GROUP BY slug, chapter)""",
        "mined",
    ),
    "terms_in_source": sql("SELECT slug, chapter, token_id, korean FROM present", "present"),
    "check_adherence": sql("SELECT slug, chapter, CAST(present AS INT) AS present, violations, missing FROM checked", "scored", more={"checked": CHECKED}),
    "adherence_rollup": sql(
        f"SELECT slug, chapter, CAST(sum(present) AS BIGINT) AS present, CAST(sum(ok) AS BIGINT) AS ok, {PERCENT} AS pct FROM checked WHERE NOT missing GROUP BY ROLLUP (slug, chapter)", "scored", more={"checked": CHECKED}
    ),
    "run_consistency": sql(
        """SELECT c.slug, c.chapter, CAST(c.present AS INT) AS present, CAST(c.ok AS INT) AS ok, CASE WHEN NOT missing THEN coalesce(v, '') END AS violations, missing FROM checked c
          LEFT JOIN (SELECT slug, chapter, string_agg(korean || '→' || english, ', ' ORDER BY token_id) AS v FROM scored WHERE NOT ok GROUP BY slug, chapter) USING (slug, chapter)""",
        "scored", more={"checked": CHECKED},
    ),
    "violations_by_term": sql(
        "SELECT slug, korean, english, count(*) AS times, string_agg(chapter, ';' ORDER BY chapter) AS chapters FROM scored WHERE NOT ok AND chapter % 10 <> 9 GROUP BY slug, korean, english", "scored"
    ),
    "adherence_by_repeat": sql(
        "SELECT slug AS experiment, chapter % 3 AS repeat, count(*) AS chapters, count(*) FILTER (missing) AS failed, CAST(coalesce(sum(present), 0) AS BIGINT) AS present, CAST(coalesce(sum(present - ok), 0) AS BIGINT) AS violations, coalesce(string_agg(v, ', ' ORDER BY chapter) FILTER (v IS NOT NULL), '') AS missed FROM checked LEFT JOIN (SELECT slug, chapter, string_agg(korean || '→' || english, ', ' ORDER BY token_id) AS v FROM scored WHERE NOT ok AND chapter % 10 <> 9 GROUP BY slug, chapter) USING (slug, chapter) GROUP BY ALL",
        "scored", more={"checked": CHECKED},
    ),
    "markup_integrity": sql(
        "SELECT slug, chapter, '1;1;' || CASE WHEN chapter % 3 = 0 THEN 1 ELSE 0 END AS source_marks, '1;' || CASE WHEN chapter % 4 = 0 THEN 0 ELSE 1 END || ';' || CASE WHEN chapter % 3 = 0 THEN 1 ELSE 0 END AS translation_marks, chapter % 4 <> 0 AS intact FROM docs",
        "docs",
    ),
    "apply_tokens": sql("SELECT slug, chapter, md5(body) AS body, array_to_string(leaked, ';') AS leaked FROM gate", "tokened", "book", more=substituted("tokened")),
    "invalid_tokens": sql("SELECT slug, chapter, array_to_string(invalid, ';') AS invalid FROM bad", "tokened", "book", more={"bad": INVALID.replace("{0}", "tokened")}),
    "new_entities": sql("SELECT * FROM entities", "tokened", more={"entities": ENTITIES}),
    "untokenized_terms": sql(
        "SELECT c.slug, c.chapter, coalesce(string_agg(f.korean || '|[[G' || f.token_id || ']]', ';' ORDER BY f.token_id), '') AS forgotten FROM chapters c LEFT JOIN forgot f USING (slug, chapter) GROUP BY c.slug, c.chapter",
        "tokened", "chapters", "glossary", more={"overs": FORGOTTEN["overs"], "forgot": FORGOTTEN["forgot"].replace("{0}", "tokened")},
    ),
    "defect_table": sql(
        """SELECT d.slug, d.chapter, coalesce(f, '') AS forgotten, array_to_string(b.invalid, ';') AS invalid, coalesce(e, '') AS new, needs_repair FROM defect d JOIN bad b USING (slug, chapter)
          LEFT JOIN (SELECT slug, chapter, string_agg(korean || '|[[G' || token_id || ']]', ';' ORDER BY token_id) AS f FROM forgot GROUP BY slug, chapter) USING (slug, chapter)
          LEFT JOIN (SELECT slug, chapter, string_agg(korean || '|' || english, ';' ORDER BY pos) AS e FROM entities GROUP BY slug, chapter) USING (slug, chapter)""",
        "tokened", "chapters", "book", more={**defects(), "entities": ENTITIES},
    ),
    "defect_files": sql(
        """SELECT d.slug, d.chapter, coalesce(f, '') AS forget, array_to_string(b.invalid, ';') AS invalid, coalesce(e, '') AS new FROM defect d JOIN bad b USING (slug, chapter)
          LEFT JOIN (SELECT slug, chapter, string_agg(korean, ';' ORDER BY token_id) AS f FROM forgot GROUP BY slug, chapter) USING (slug, chapter)
          LEFT JOIN (SELECT slug, chapter, string_agg(korean || '|' || english, ';' ORDER BY pos) AS e FROM entities GROUP BY slug, chapter) USING (slug, chapter)""",
        "tokened", "chapters", "book", more={**defects(), "entities": ENTITIES},
    ),
    "chapter_report": sql(
        """SELECT g.slug, g.chapter, CASE WHEN len(leaked) > 0 THEN 'NEEDS_HUMAN' ELSE 'ok' END AS status, array_to_string(list_sort(list_distinct(leaked)), ';') AS leaks, CAST(len(leaked) AS INT) AS n_leaks,
          d.forgotten, d.invalid, d.new, g.chapter % 6 = 1 AS rejected, CASE WHEN len(leaked) = 0 THEN CAST(coalesce(n, 0) AS INT) END AS present, CASE WHEN len(leaked) = 0 THEN coalesce(v, '') END AS violations
          FROM gate g JOIN defect d USING (slug, chapter) LEFT JOIN (SELECT slug, chapter, count(*) AS n, string_agg(korean, ';' ORDER BY token_id) FILTER (NOT ok) AS v FROM judged_terms GROUP BY slug, chapter) USING (slug, chapter)""",
        "tokened", "chapters", "book", "present",
        more={
            **substituted("tokened"), **defects(), **JUDGED_TERMS,
        },
    ),
    "defect_totals": sql(
        "SELECT slug, CAST(sum(forgotten) AS BIGINT) AS forgotten, CAST(sum(invalid) AS BIGINT) AS invalid, CAST(sum(new) AS BIGINT) AS new, count(*) FILTER (needs_repair) AS need_repair FROM defect GROUP BY ROLLUP (slug)",
        "tokened", "chapters", "book", more=defects(),
    ),
    "fail_closed_gate": sql(
        """SELECT slug, chapter, CASE WHEN len(leaked) > 0 THEN 'NEEDS_HUMAN' ELSE 'ok' END AS status, l AS leaks, md5(CASE WHEN len(leaked) > 0 THEN '[withheld: ' || replace(l, ';', ', ') || ']' ELSE body END) AS body
          FROM (SELECT *, array_to_string(list_sort(list_distinct(leaked)), ';') AS l FROM gate)""",
        "tokened", "book", more=substituted("tokened"),
    ),
    "context_window": sql("SELECT slug, chapter, prior FROM w", "summaries", more={"w": window_of(20)}),
    "last_k_summaries": sql(LAST_THREE, "summaries"),
    "glossary_table": sql(f'SELECT slug, CAST(count(*) AS INT) AS n_terms, string_agg({TABLE_LINE}, chr(10) ORDER BY token_id) AS "table" FROM glossary GROUP BY slug', "glossary"),
    "placeholder_block": sql(BLOCK, "glossary"),
    "user_message": sql(
        "SELECT slug, chapter, length(m) AS n_chars, md5(m) AS digest FROM (SELECT c.slug, c.chapter, " + message("CASE WHEN c.chapter % 4 = 0 THEN '<story_so_far>' || chr(10) || 'So far.' || chr(10) || '</story_so_far>' || chr(10) || chr(10) ELSE '' END") + " AS m FROM chapters c JOIN w USING (slug, chapter))",
        "chapters", "summaries", more={"w": window_of(5)},
    ),
    "mining_requests": sql(
        f"SELECT slug, chapter, 'mine:' || slug || ':' || chapter AS custom_id, CAST(2000 AS INT) AS max_tokens, md5('<chapter>' || chr(10) || {strip('text')} || chr(10) || '</chapter>') AS user_digest, md5('') AS block_digest FROM chapters WHERE {strip('text')} <> ''", "chapters"
    ),
    "consolidation_requests": sql(
        f"SELECT slug, 'CONSOLIDATE' || chr(10) || chr(10) || '# Draft glossary (' || count(*) || ' entries)' || chr(10) || chr(10) || string_agg({TABLE_LINE}, chr(10) ORDER BY token_id) || chr(10) AS prompt FROM glossary GROUP BY slug", "glossary"
    ),
    "translation_requests": sql(
        "SELECT slug, chapter, 'translate:' || slug || ':' || chapter AS custom_id, CAST(16000 AS INT) AS max_tokens, md5(m) AS user_digest, md5(coalesce(block, '')) AS block_digest FROM (SELECT c.slug, c.chapter, " + message(f"coalesce('<story_so_far>' || chr(10) || trim({ARC}) || chr(10) || '</story_so_far>' || chr(10) || chr(10), '')") + " AS m FROM chapters c JOIN w USING (slug, chapter)) LEFT JOIN block USING (slug) WHERE m IS NOT NULL",
        "chapters", "summaries", "glossary", "arcs", more={"w": window_of(20), "block": BLOCK},
    ),
    "repair_requests": sql(
        """SELECT d.slug, d.chapter, 'repair:' || d.slug || ':' || d.chapter AS custom_id, CAST(16000 AS INT) AS max_tokens,
          md5('<source>' || chr(10) || c.text || chr(10) || '</source>' || chr(10) || chr(10) || '<translation>' || chr(10) || t.raw || chr(10) || '</translation>'
            || coalesce(chr(10) || chr(10) || '<missed>' || chr(10) || m || chr(10) || '</missed>', '')
            || CASE WHEN len(b.invalid) > 0 THEN chr(10) || chr(10) || '<invalid>' || chr(10) || array_to_string(list_sort(list_distinct(b.invalid)), chr(10)) || chr(10) || '</invalid>' ELSE '' END) AS user_digest,
          md5(CASE WHEN len(b.invalid) > 0 THEN coalesce(block, '') ELSE '' END) AS block_digest
          FROM defect d JOIN chapters c USING (slug, chapter) JOIN tokened t USING (slug, chapter) JOIN bad b USING (slug, chapter)
          LEFT JOIN (SELECT slug, chapter, string_agg(korean || ' | [[G' || token_id || ']]', chr(10) ORDER BY token_id) AS m FROM forgot GROUP BY slug, chapter) USING (slug, chapter) LEFT JOIN block USING (slug) WHERE needs_repair""",
        "tokened", "chapters", "book", more={**defects(), "block": BLOCK},
    ),
    "arc_requests": sql(
        f"""SELECT slug, chapter, n_summaries, md5('ARC' || chr(10) || chr(10) || '<current_story_so_far>' || chr(10) || coalesce(trim({ARC}), '(empty)') || chr(10) || '</current_story_so_far>' || chr(10) || chr(10)
            || '<recent_chapter_summaries>' || chr(10) || lines || chr(10) || '</recent_chapter_summaries>') AS digest
          FROM (SELECT a.slug, a.chapter, CAST(count(*) AS INT) AS n_summaries, string_agg('Ch.' || b.chapter || ': ' || b.summary, chr(10) ORDER BY b.chapter) AS lines
            FROM summaries a JOIN summaries b ON a.slug = b.slug AND b.chapter <= a.chapter AND b.summary IS NOT NULL
            WHERE a.chapter % 5 = 0 AND a.chapter < (SELECT max(z.chapter) FROM summaries z WHERE z.slug = a.slug) GROUP BY a.slug, a.chapter) c""",
        "summaries", "arcs",
    ),
    "token_estimate": sql("SELECT slug, chapter, h + (length(text) - h) // 4 AS estimate FROM (SELECT *, length(regexp_replace(text, '[^가-힣]', '', 'g')) AS h FROM chapters)", "chapters"),
    "call_cost": sql("SELECT tag, model, chapter, seq, batch, round(cost_usd, 6) AS cost_usd FROM costed", "costed"),
    "unpriced_calls": sql("SELECT tag, model, chapter, seq FROM calls WHERE model NOT IN (SELECT model FROM pricing)", "costed"),
    "cost_rollup": sql("SELECT tag, model, batch, count(*) AS calls, round(sum(cost_usd), 6) AS cost_usd FROM costed GROUP BY CUBE (tag, model, batch)", "costed"),
    "parse_failure_rate": sql("SELECT variant, count(*) AS runs, count(*) FILTER (NOT parse_ok) AS failures, count(*) FILTER (NOT parse_ok) / count(*) AS rate FROM calls GROUP BY variant", "calls"),
    "variant_compare": sql(
        "SELECT tag, " + ", ".join(f"count(*) FILTER (variant = '{v}') AS {v}_calls, count(*) FILTER (variant = '{v}' AND parse_ok) AS {v}_ok, CAST(coalesce(sum(terms) FILTER (variant = '{v}'), 0) AS BIGINT) AS {v}_terms, round(coalesce(sum(cost_usd) FILTER (variant = '{v}'), 0), 6) AS {v}_cost" for v in ("combined", "split")) + " FROM costed GROUP BY tag",
        "costed",
    ),
    "cache_hits": sql(
        "SELECT slug, count(*) - 1 AS later, count(*) FILTER (k > 1 AND cache_read_tokens > 0) AS hits, CASE WHEN count(*) > 1 THEN count(*) FILTER (k > 1 AND cache_read_tokens > 0) / (count(*) - 1) ELSE 0 END AS rate FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY chapter, seq, cache_read_tokens) AS k FROM calls) GROUP BY slug",
        "calls",
    ),
    "retry_resolution": sql(
        """SELECT slug, chapter, count(*) AS attempts, CAST(coalesce(any_value(used), 0) AS INT) AS used, round(arg_max(cost_usd, k), 6) AS last_cost, round(sum(cost_usd), 6) AS logged_cost FROM (
          SELECT *, min(k) FILTER (parse_ok) OVER (PARTITION BY slug, chapter) AS used FROM (SELECT *, row_number() OVER (PARTITION BY slug, chapter ORDER BY seq, parse_ok DESC, cost_usd) AS k FROM costed) WHERE k <= 2
        ) WHERE used IS NULL OR k <= used GROUP BY slug, chapter""",
        "costed",
    ),
    "judge_pairs": sql(
        """SELECT a.chapter, p.pair, CASE WHEN (a.chapter + p.pair) % 2 = 1 THEN m2 ELSE m1 END AS a, CASE WHEN (a.chapter + p.pair) % 2 = 1 THEN m1 ELSE m2 END AS b,
          CASE WHEN (a.chapter + p.pair) % 2 = 1 THEN m2 ELSE m1 END || ':' || md5(text) AS text_a, CASE WHEN (a.chapter + p.pair) % 2 = 1 THEN m1 ELSE m2 END || ':' || md5(text) AS text_b
          FROM docs a, (VALUES (0, 'large', 'medium'), (1, 'large', 'small'), (2, 'medium', 'small')) AS p(pair, m1, m2) WHERE NOT (a.chapter % 5 = 2 AND 'medium' IN (m1, m2))""",
        "docs",
    ),
    "judge_tally": sql(
        """SELECT winner, count(*) AS times FROM (
          SELECT CASE WHEN overall IS NULL THEN 'judge_parse_error' WHEN overall = 'tie' THEN 'tie' WHEN (overall = 'A') = ((chapter + pair) % 2 = 0) THEN ['large', 'large', 'medium'][pair + 1] ELSE ['medium', 'small', 'small'][pair + 1] END AS winner FROM judged
        ) GROUP BY winner""",
        "verdict_replies", more={"judged": JUDGED},
    ),
    "judge_by_model": sql(
        """SELECT model, count(*) AS judged, count(*) FILTER (overall <> 'tie' AND (overall = 'A') = (model = a)) AS wins, count(*) FILTER (overall = 'tie') AS ties, count(*) FILTER (overall IS NULL) AS unparsed FROM (
          SELECT overall, a, unnest([a, b]) AS model FROM (
            SELECT overall, CASE WHEN (chapter + pair) % 2 = 1 THEN y ELSE x END AS a, CASE WHEN (chapter + pair) % 2 = 1 THEN x ELSE y END AS b
            FROM (SELECT *, ['large', 'large', 'medium'][pair + 1] AS x, ['medium', 'small', 'small'][pair + 1] AS y FROM judged))
        ) GROUP BY model""",
        "verdict_replies", more={"judged": JUDGED},
    ),
    "cost_projection": sql(
        "SELECT model, batch, round(avg(c), 6) AS per_chapter, round(avg(c) * 1000000, 0) AS corpus FROM (SELECT model, batch, chapter, sum(cost_usd) AS c FROM costed GROUP BY model, batch, chapter) GROUP BY model, batch", "costed"
    ),
}

# The real-time loop: o numbers a book's chapters, ok has the replies that parse, grown the terms in order of appearance.
LOOP = {
    **TERMS,
    "num": "SELECT slug, chapter, CAST(row_number() OVER (PARTITION BY slug ORDER BY chapter) AS INT) AS o FROM docs",
    "ok": "SELECT slug, o, summary, translation FROM mining JOIN num USING (slug, chapter) WHERE mining_error = '' AND coalesce(translation, '') <> ''",
    "grown": """SELECT slug, o, CAST(row_number() OVER (PARTITION BY slug ORDER BY o, pos) AS INT) AS token_id, korean, english, category, note, enforce FROM (
      SELECT t.*, n.o, row_number() OVER (PARTITION BY t.slug, korean ORDER BY n.o, pos) AS k FROM terms t JOIN num n USING (slug, chapter) JOIN ok ON ok.slug = t.slug AND ok.o = n.o) WHERE k = 1""",
    "sizes": "SELECT n.slug, n.o, CAST(count(g.token_id) AS INT) AS size FROM num n LEFT JOIN grown g ON g.slug = n.slug AND g.o < n.o GROUP BY n.slug, n.o",
    "src": "SELECT slug, chapter, text FROM chapters",
}
_STORY = "(SELECT arg_max(x.o, x.o) FROM num x WHERE x.slug = c.slug AND x.o < c.o AND x.o % 5 = 0 AND x.chapter % 3 <> 0)"
SQL["glossary_files"] = f"SELECT *, '' AS reason FROM ({SQL['fold_back']})"
SQL["deliverable_files"] = f"SELECT replace(name, '_INCOMPLETE', '') AS slug, contains(name, '_INCOMPLETE') AS incomplete, n_chars, digest FROM ({SQL['deliverable']})"
SQL["report_files"] = f"""SELECT *, coalesce((SELECT count(*) FILTER (p.parse_error = '') FROM ({SQL['parse_translations']}) p WHERE p.slug = r.slug), 0) AS parse_ok FROM (
  SELECT slug, CASE WHEN bool_or(status <> 'ok') THEN 'NEEDS_HUMAN' ELSE 'OK' END AS status, count(*) AS chapters, CAST(coalesce(sum(present), 0) AS BIGINT) AS present,
    CAST(coalesce(sum(present - CASE WHEN violations = '' THEN 0 ELSE len(string_split(violations, ';')) END), 0) AS BIGINT) AS ok, CAST(sum(n_leaks) AS BIGINT) AS leaks,
    coalesce(string_agg(chapter, ';' ORDER BY chapter) FILTER (status <> 'ok'), '') AS withheld, coalesce(string_agg(chapter, ';' ORDER BY chapter) FILTER (rejected), '') AS rejected,
    CAST(sum(forgotten) AS BIGINT) AS forgotten, CAST(sum(invalid) AS BIGINT) AS invalid, CAST(sum(new) AS BIGINT) AS new,
    md5(string_agg(chapter || '|' || leaks || '|' || coalesce(violations, ''), '/' ORDER BY chapter)) AS per_chapter
  FROM ({SQL['chapter_report']}) GROUP BY slug) r"""
_WINDOWS = "SELECT called // 604800 * 604800 AS start, tag, model, count(*) AS calls, count(*) FILTER (cache_read_tokens > 0) AS hits, round(sum({0}), {1}) AS cost_usd FROM {2} GROUP BY ALL"
SQL["cost_windows"] = sql(_WINDOWS.format("cost_usd", 6, "costed"), "costed")
SQL["stream_costs"] = sql(
    _WINDOWS.format("round(cost_usd, 6)", 6, "kept"), "costed",
    more={"kept": "SELECT * FROM (SELECT *, min(called) OVER () AS low, max(called) OVER () AS high FROM costed) WHERE NOT (4 * (called - low) < high - low + 1 AND chapter % 97 = 0)"},
)
SQL["maintained_terms"] = SQL["merge_terms"]
SQL["slice_files"] = SQL["slice_chapters"]
SQL["stream_requests"] = sql(
    "SELECT slug, o AS chapter, size, md5(m) AS digest FROM (SELECT c.slug, c.o, c.size, " + message(f"coalesce('<story_so_far>' || chr(10) || 'The story up to ' || {_STORY} || '.' || chr(10) || '</story_so_far>' || chr(10) || chr(10), '')") + """ AS m
      FROM (SELECT s.*, z.o, z.size FROM src s JOIN num USING (slug, chapter) JOIN sizes z USING (slug, o)) c
      JOIN (SELECT n.slug, n.o, coalesce((SELECT string_agg('Ch.' || y.o || ': ' || y.summary, chr(10) ORDER BY y.o) FROM (SELECT k.o, k.summary FROM ok k WHERE k.slug = n.slug AND k.o < n.o ORDER BY k.o DESC LIMIT 3) y), '') AS lines FROM num n) w USING (slug, o)) WHERE m IS NOT NULL""",
    "replies", "chapters", more=LOOP,
)
# Each chapter is a book of its own with the terms that its request showed, so that the tables of chapter_report do.
_AS_BOOKS = {
    "tokened": "SELECT slug || '#' || o AS slug, o AS chapter, translation AS raw FROM ok",
    "chapters": "SELECT slug || '#' || n.o AS slug, n.o AS chapter, src.text FROM src JOIN num n USING (slug, chapter)",
    "glossary": "SELECT k.slug || '#' || k.o AS slug, g.token_id, g.korean, g.english, g.category, g.note, g.enforce FROM ok k JOIN grown g ON g.slug = k.slug AND g.o < k.o",
    "book": CTES["book"],
    "present": CTES["present"],
}
SQL["stream_gate"] = sql(
    "SELECT * FROM (WITH " + ", ".join(f"{n} AS ({q})" for n, q in {**_AS_BOOKS, **substituted("tokened"), **defects(), **JUDGED_TERMS}.items()) + """
      SELECT split_part(g.slug, '#', 1) AS slug, g.chapter, z.size, CASE WHEN len(leaked) > 0 THEN 'NEEDS_HUMAN' ELSE 'ok' END AS status, l AS leaks,
        md5(CASE WHEN len(leaked) > 0 THEN '[withheld: ' || replace(l, ';', ', ') || ']' ELSE body END) AS body, d.forgotten, d.invalid, d.new,
        CASE WHEN len(leaked) = 0 THEN CAST(coalesce(n, 0) AS INT) END AS present, CASE WHEN len(leaked) = 0 THEN coalesce(v, '') END AS violations
      FROM (SELECT *, array_to_string(list_sort(list_distinct(leaked)), ';') AS l FROM gate) g JOIN defect d USING (slug, chapter) JOIN sizes z ON z.slug = split_part(g.slug, '#', 1) AND z.o = g.chapter
      LEFT JOIN (SELECT slug, chapter, count(*) AS n, string_agg(korean, ';' ORDER BY token_id) FILTER (NOT ok) AS v FROM judged_terms GROUP BY slug, chapter) USING (slug, chapter))""",
    "replies", "chapters", more=LOOP,
)
# A glossary that grows from nothing, in the order of chapters.
SQL["stream_glossary"] = sql(
    f"""SELECT slug, CAST(row_number() OVER (PARTITION BY slug ORDER BY chapter, pos) AS INT) AS token_id, korean, english, category, note, enforce
      FROM (SELECT *, row_number() OVER (PARTITION BY slug, korean ORDER BY chapter, pos) AS k FROM ({GOOD_TERMS})) WHERE k = 1""",
    "replies", more=TERMS,
)
SQL["stream_summaries"] = sql("SELECT slug, chapter, summary FROM mining WHERE mining_error = ''", "replies", more=REPLY_TABLES)
