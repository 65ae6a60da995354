"""The derived tables in DuckDB's SQL, as common table expressions."""

SYLLABLES = "'가나다도은바사이아자차를마에과파카로만의와하을타는씨'"


def hangul(c: str) -> str:
    return f"translate(lower({c}), 'abcdefghijklmnopqrstuvwxyz', {SYLLABLES})"


def letter(c: str, at: int, n: int) -> str:
    return f"(ascii(substr({c}, {at}, 1)) % {n})"


CATEGORY = "['person', 'place', 'organization', 'technique', 'rank_title', 'item', 'creature', 'other']"
INITCAP = "upper(substr({0}, 1, 1)) || lower(substr({0}, 2))"

CTES = {
    "docs": "SELECT source || '-' || CAST(doc_id // 2000 AS VARCHAR) AS slug, CAST(doc_id AS INT) AS chapter, coalesce(text, '') AS text FROM documents",
    "chapters": f"SELECT slug, chapter, {hangul('text')} AS text FROM docs",
    "found_terms": """SELECT slug, chapter, pos, substr(word, 1, 6) AS term FROM (
      SELECT slug, chapter, generate_subscripts(w, 1) - 1 AS pos, unnest(w) AS word FROM (SELECT slug, chapter, regexp_extract_all(lower(text), '[a-z]{13,}') AS w FROM docs))""",
    "glossary": f"""SELECT slug, CAST(row_number() OVER (PARTITION BY slug ORDER BY first, term) AS INT) AS token_id, {hangul('term')} AS korean,
      CASE {letter('term', 2, 6)} WHEN 0 THEN {INITCAP.format('reverse(term)')} WHEN 1 THEN 'The Of' WHEN 2 THEN 'the ' || upper(term) ELSE {INITCAP.format('term')} END AS english,
      {CATEGORY}[{letter('term', 1, 8)} + 1] AS category,
      CASE WHEN {letter('term', 3, 3)} = 0 THEN 'as ' || term ELSE '' END AS note,
      {letter('term', 4, 4)} <> 0 AS enforce
      FROM (SELECT slug, term, min(chapter) AS first FROM found_terms GROUP BY slug, term)""",
    "mined": f"""SELECT slug, chapter, pos,
      CASE chapter % 3 WHEN 0 THEN k WHEN 1 THEN k || ' (주)' ELSE substr(k, 1, 2) || ' ' || substr(k, 3, 4) END AS korean,
      CASE pos % 4 WHEN 0 THEN e || '/Alt' WHEN 1 THEN e || ' (or X)' WHEN 2 THEN e ELSE e || 's' END AS english,
      {CATEGORY}[(chapter + pos) % 8 + 1] AS category,
      CASE WHEN pos % 2 = 0 THEN '' ELSE 'n' || chapter END AS note, pos % 5 <> 0 AS enforce
      FROM (SELECT *, {hangul('term')} AS k, {INITCAP.format('term')} AS e FROM found_terms)""",
    "tokened": """SELECT slug, chapter,
      replace(replace(text, ' the ', ' [[G' || (chapter % 60 + 1) || ']] '), ' de ', ' [[ g 0' || (chapter % 7) || ']] ')
      || [' [[G9999]] x [[G9999]]', ' [[NEW:백호|Baekho]]''s', ' [[[G1]] and [[NEW:x|]]', ' [[Great Hall]] [[G3 summit]]', ' [[G134:무림|Murim ]] [[NEW: 검성 | Sword ]]', ' [[G1', ' [[NEW:신]] [[G99999999999]]', ''][chapter % 8 + 1] AS raw
      FROM docs""",
    "term_lines": """SELECT slug, chapter, string_agg(line, chr(10) ORDER BY pos) AS block FROM (
      SELECT slug, chapter, pos, CASE
        WHEN chapter % 11 = 3 AND pos = 1 THEN korean || ' | ' || english
        WHEN chapter % 13 = 5 AND pos = 0 THEN korean || ' | ' || english || ' | bogus'
        WHEN chapter % 17 = 7 AND pos = 0 THEN ' | ' || english || ' | item'
        WHEN pos % 3 = 0 THEN '`' || korean || ' | ' || english || ' | ' || category || '`'
        WHEN pos % 3 = 1 THEN korean || '|' || english || '|' || category || '| ' || note
        ELSE korean || ' | ' || english || ' | ' || category || ' | ' || note || ' | ' || CASE WHEN enforce THEN 'yes' WHEN chapter % 2 = 0 THEN 'Soft' ELSE '0' END || ' | more' END AS line
      FROM mined) GROUP BY slug, chapter""",
    "replies": """SELECT slug, chapter,
      CASE WHEN chapter % 19 = 4 THEN '<translation> ' || chr(10) || ' </translation>' WHEN chapter % 23 = 6 THEN 'no tags' ELSE '<translation>' || chr(10) || raw || chr(10) || '</translation>' END
      || CASE WHEN chapter % 29 = 8 THEN '' ELSE chr(10) || '<new_glossary_terms>' || chr(10) || CASE WHEN chapter % 7 = 2 THEN 'NONE (nothing new)' ELSE coalesce(block, 'none') END || chr(10) || '</new_glossary_terms>' END
      || CASE WHEN chapter % 31 = 9 THEN chr(10) || '<chapter_summary></chapter_summary>' ELSE chr(10) || '<chapter_summary>' || chr(10) || ' Chapter ' || chapter || ' in short. ' || chr(10) || '</chapter_summary>' END AS raw
      FROM tokened LEFT JOIN term_lines USING (slug, chapter)""",
    "summaries": "SELECT slug, chapter, CASE WHEN chapter % 5 <> 3 THEN 'Chapter ' || chapter || ' in short.' END AS summary FROM docs",
    "arcs": "SELECT slug, chapter, CASE WHEN chapter % 3 <> 0 THEN ' The story up to ' || chapter || '. ' END AS arc FROM docs WHERE chapter % 5 = 0",
    "calls": """SELECT ['mine', 'translate', 'repair', 'judge'][l_linenumber % 4 + 1] AS tag,
      CASE WHEN l_partkey % 50 = 0 THEN 'unknown' ELSE ['large', 'medium', 'small'][l_suppkey % 3 + 1] END AS model,
      'run' || (l_orderkey % 100) AS slug, l_orderkey AS chapter, l_returnflag = 'R' AS batch,
      CAST(l_quantity AS BIGINT) * 200 + 100 AS input_tokens, CAST(l_quantity AS BIGINT) * 90 AS output_tokens,
      CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_quantity AS BIGINT) * 1000 ELSE 0 END AS cache_read_tokens,
      CASE WHEN l_linenumber = 1 THEN CAST(l_quantity AS BIGINT) * 1000 ELSE 0 END AS cache_write_tokens,
      l_partkey % 9 <> 0 AS parse_ok, CASE WHEN l_partkey % 9 <> 0 THEN l_linenumber % 5 ELSE 0 END AS terms, ['combined', 'split'][l_partkey % 2 + 1] AS variant, l_linenumber AS seq, CAST(epoch(l_shipdate) AS BIGINT) + l_orderkey % 86400 AS called
      FROM lineitem""",
    "pricing": "SELECT * FROM (VALUES ('large', 5.0::DOUBLE, 25.0::DOUBLE), ('medium', 3.0, 15.0), ('small', 1.0, 5.0)) AS v(model, input_price, output_price)",
    "costed": """SELECT c.*, ((input_tokens + 0.1::DOUBLE * cache_read_tokens + 1.25::DOUBLE * cache_write_tokens) * input_price / 1e6 + output_tokens * output_price / 1e6) * CASE WHEN batch THEN 0.5::DOUBLE ELSE 1 END AS cost_usd
      FROM calls c JOIN pricing USING (model)""",
    "verdict_replies": """SELECT event_id // 3 AS chapter, CAST(event_id % 3 AS INT) AS pair,
      '<accuracy>' || CASE WHEN event_id % 2 = 0 THEN 'A' ELSE 'tie' END || '</accuracy>' || chr(10) || '<voice>B wins</voice>' || chr(10) || '<terminology>?</terminology>' || chr(10)
      || CASE WHEN event_id % 11 = 10 THEN '' ELSE '<overall_winner>' || ['A', 'b', 'It is a Tie', 'tie', 'Translation B.', 'nobody', ' ', 'TIE'][event_id % 8 + 1] || '</overall_winner>' END
      || CASE WHEN event_id % 4 = 0 THEN '<rationale> since ' || event_type || ' </rationale>' ELSE '' END AS raw
      FROM events""",
    "novels": """SELECT slug, 'front matter' || chr(10) || string_agg(chr(10) || chapter || CASE WHEN chapter % 4 = 1 THEN '화' WHEN chapter % 9 = 2 THEN '화살' ELSE '화 제목' END || chr(10) || text || '  ' || chr(10), '' ORDER BY chapter) AS text
      FROM chapters GROUP BY slug""",
    "book": "SELECT slug, count(*) AS n_terms, map(list(token_id ORDER BY token_id), list(english ORDER BY token_id)) AS ids FROM glossary GROUP BY slug",
    "present": """SELECT c.slug, c.chapter, g.token_id, g.korean, g.english, g.category, g.note, g.enforce FROM chapters c JOIN glossary g USING (slug)
      WHERE contains(c.text, g.korean) AND regexp_matches(c.text, '(^|[^가-힣])' || regexp_escape(g.korean) || '($|[^가-힣]|으로써|으로서|에서는|에게서|이라고|이라는|으로|에서|에게|한테|처럼|만큼|까지|부터|보다|라고|라는|마저|조차|밖에|이나|은|는|이|가|을|를|과|와|의|에|로|도|만|님|씨|들|이었|였다|였고|였어|였|이다|이라|이고|이며|이야|이지|예요|입니|인)')""",
    "scored": """SELECT p.*, contains(lower(d.text), lower(p.english)) OR (len(p.wanted) > 0 AND len(list_filter(p.wanted, lambda w: NOT list_contains(d.words, w))) = 0) AS ok
      FROM (SELECT *, list_filter(list_distinct(regexp_split_to_array(lower(english), '[^0-9a-z-]+')), lambda w: w NOT IN ('', 'the', 'of', 'a', 'an', 'and', 's')) AS wanted FROM present) p
      JOIN (SELECT slug, chapter, text, list_distinct(regexp_split_to_array(lower(text), '[^0-9a-z-]+')) AS words FROM docs) d USING (slug, chapter)""",
}

_NEEDS = {
    "chapters": ["docs"], "found_terms": ["docs"], "glossary": ["found_terms"], "mined": ["found_terms"], "tokened": ["docs"], "term_lines": ["mined"],
    "replies": ["tokened", "term_lines"], "summaries": ["docs"], "arcs": ["docs"], "costed": ["calls", "pricing"], "novels": ["chapters"], "book": ["glossary"],
    "present": ["chapters", "glossary"], "scored": ["present", "docs"],
}


def sql(body: str, *tables: str, more: dict[str, str] | None = None) -> str:
    """body after a WITH of these tables and all that they need."""
    order: list[str] = []

    def need(name: str) -> None:
        for other in _NEEDS.get(name, []):
            need(other)
        if name not in order:
            order.append(name)

    for name in tables:
        need(name)
    parts = [f"{n} AS ({CTES[n]})" for n in order] + [f"{n} AS ({q})" for n, q in (more or {}).items()]
    return f"WITH {', '.join(parts)}\n{body}" if parts else body
