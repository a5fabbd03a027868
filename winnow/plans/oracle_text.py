"""DuckDB SQL for the text rules, as WITH-clause parts over a relation (id, text)."""

from __future__ import annotations

from winnow.functions import html
from winnow.functions.limits import (
    LINE_END_PUNCTUATION,
    C4Quality,
    FineWebQuality,
    GopherQuality,
    GopherRepetition,
)

WS = r"[ \t\n\r\f]+"


def quoted(items) -> str:
    return ", ".join("'" + str(item).replace("'", "''") + "'" for item in items)


def words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{WS}'), lambda w: w <> '')"


def lines(text: str) -> str:
    return (
        f"list_filter(list_transform(string_split({text}, chr(10)), lambda l: trim(l)), "
        "lambda l: l <> '')"
    )


def chars(items: str) -> str:
    return f"coalesce(list_sum(list_transform({items}, lambda x: length(x))), 0)"


def share(part: str, whole: str) -> str:
    return (
        f"(CASE WHEN ({whole}) > 0 THEN ({part})::DOUBLE / ({whole})::DOUBLE ELSE 0.0::DOUBLE END)"
    )


def count_of(text: str, needle: str) -> str:
    return f"((length({text}) - length(replace({text}, '{needle}', ''))) / {float(len(needle))})"


def case(rules: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {cond} THEN '{name}'" for name, cond in rules) + " END"


def dup_count(items: str) -> str:
    return share(f"len({items}) - len(list_distinct({items}))", f"len({items})")


def dup_chars(items: str, whole: str) -> str:
    return share(f"{chars(items)} - {chars(f'list_distinct({items})')}", whole)


def quality(src: str, out: str, limits: GopherQuality = GopherQuality()) -> str:
    """CTEs ending in `out`(id, text, reason)."""
    n = "len(words)"
    alpha = r"len(list_filter(words, lambda w: regexp_matches(w, '\p{L}')))"
    bullets = "len(list_filter(ls, lambda l: regexp_matches(l, '^[•‣*-]')))"
    dots = r"len(list_filter(ls, lambda l: regexp_matches(l, '(\.\.\.|…)\z')))"
    mean = share(f"length(regexp_replace(text, '{WS}', '', 'g'))", n)
    ellipsis = share(f"{count_of('text', '...')} + {count_of('text', '…')}", n)
    rules = [
        ("too_few_words", f"{n} < {limits.min_words}"),
        ("too_many_words", f"{n} > {limits.max_words}"),
        ("short_words", f"{mean} < {limits.min_mean_length}"),
        ("long_words", f"{mean} > {limits.max_mean_length}"),
        ("hash_ratio", f"{share(count_of('text', '#'), n)} > {limits.max_symbol_ratio}"),
        ("ellipsis_ratio", f"{ellipsis} > {limits.max_symbol_ratio}"),
        ("bullet_lines", f"{share(bullets, 'len(ls)')} > {limits.max_bullet_lines}"),
        ("ellipsis_lines", f"{share(dots, 'len(ls)')} > {limits.max_ellipsis_lines}"),
        ("alpha_words", f"{share(alpha, n)} < {limits.min_alpha_words}"),
        ("stop_words", f"stops < {limits.min_stop_words}"),
    ]
    return f"""
    {out}_w AS (
      SELECT id, text, {words('text')} AS words, {lines('text')} AS ls,
             len(list_intersect(list_distinct(regexp_split_to_array(lower(text), '[^\\p{{L}}]+')),
                                [{quoted(limits.stop_words)}])) AS stops
      FROM {src}),
    {out} AS (SELECT id, text, {case(rules)} AS reason FROM {out}_w)"""


def repetition(src: str, out: str, limits: GopherRepetition = GopherRepetition()) -> str:
    parts = [
        f"""
    {out}_w AS (
      SELECT id, text, {words('text')} AS words,
             regexp_split_to_array(body, '\\n+') AS ls, regexp_split_to_array(body, '\\n{{2,}}') AS ps
      FROM (SELECT id, text, regexp_replace(text, '\\A\\n+|\\n+\\z', '', 'g') AS body FROM {src})),
    {out}_p AS (SELECT id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM {out}_w),
    {out}_c AS (SELECT id, sum(length(word)) AS chars FROM {out}_p GROUP BY id)"""
    ]
    rules = [
        ("dup_paragraph", f"{dup_count('ps')} > {limits.dup_paragraph}"),
        ("dup_paragraph_chars", f"{dup_chars('ps', 'length(text)')} > {limits.dup_paragraph_chars}"),
        ("dup_line", f"{dup_count('ls')} > {limits.dup_line}"),
        ("dup_line_chars", f"{dup_chars('ls', 'length(text)')} > {limits.dup_line_chars}"),
    ]
    joins = ""
    for n in [*sorted(limits.top_ngram), *sorted(limits.dup_ngram)]:
        parts.append(
            f"""
    {out}_g{n} AS (
      SELECT id, p, array_to_string(words[p:p + {n - 1}], ' ') AS gram
      FROM (SELECT id, words, unnest(range(1, len(words) - {n - 2})) AS p
            FROM {out}_w WHERE len(words) >= {n}))"""
        )
    for n, limit in sorted(limits.top_ngram.items()):
        parts.append(
            f"""
    {out}_t{n} AS (
      SELECT id, max(c * 100000000 + l) AS best FROM (
        SELECT id, count(*) AS c, length(gram) AS l FROM {out}_g{n} GROUP BY id, gram)
      GROUP BY id)"""
        )
        joins += f" LEFT JOIN {out}_t{n} t{n} ON t{n}.id = w.id"
        best = f"coalesce((t{n}.best // 100000000) * (t{n}.best % 100000000), 0)"
        rules.append((f"top_{n}_gram", f"{share(best, 'length(text)')} > {limit}"))
    for n, limit in sorted(limits.dup_ngram.items()):
        parts.append(
            f"""
    {out}_r{n} AS (
      SELECT DISTINCT id, unnest(range(p, p + {n})) AS pos FROM (
        SELECT id, p, row_number() OVER (PARTITION BY id, gram ORDER BY p) AS k FROM {out}_g{n})
      WHERE k > 1),
    {out}_d{n} AS (
      SELECT r.id, sum(length(word)) AS covered
      FROM {out}_r{n} r JOIN {out}_p p ON p.id = r.id AND p.pos = r.pos GROUP BY r.id)"""
        )
        joins += f" LEFT JOIN {out}_d{n} d{n} ON d{n}.id = w.id"
        rules.append(
            (f"dup_{n}_gram", f"{share(f'coalesce(d{n}.covered, 0)', 'coalesce(c.chars, 0)')} > {limit}")
        )
    parts.append(
        f"""
    {out} AS (SELECT w.id, text, {case(rules)} AS reason
      FROM {out}_w w LEFT JOIN {out}_c c ON c.id = w.id{joins})"""
    )
    return ",".join(parts)


def c4(src: str, out: str, limits: C4Quality = C4Quality()) -> str:
    phrases = " AND ".join(
        f"NOT contains(lower(l), '{p}')" for p in ("javascript", *limits.policy_phrases)
    )
    more = r"[ \t\r\f]+[^ \t\r\f]+" * (limits.min_line_words - 1)
    word_length = (
        f"coalesce(list_max(list_transform({words('l')}, lambda x: length(x))), 0)"
        f" <= {limits.max_word_length}"
    )
    sentences = (
        r"len(regexp_extract_all(cleaned, '[.!?]+(?:[ \t\n\r\f]|\z)')) + "
        rf"len(list_filter({lines('cleaned')}, lambda l: NOT regexp_matches(l, '[.!?]\z')))"
    )
    rules = [
        ("lorem_ipsum", "contains(lower(text), 'lorem ipsum')"),
        ("curly_bracket", "contains(text, '{')"),
        ("too_few_sentences", f"{sentences} < {limits.min_sentences}"),
    ]
    return f"""
    {out}_w AS (
      SELECT id, text, array_to_string(list_filter(
        list_transform(string_split(
          regexp_replace(text, '\\[\\d*\\]|\\[edit\\]|\\[citation needed\\]', '', 'g'), chr(10)),
          lambda l: trim(l)),
        lambda l: regexp_matches(l, '^[^ \\t\\r\\f]+{more}') AND {phrases} AND {word_length}),
        chr(10)) AS cleaned
      FROM {src}),
    {out} AS (SELECT id, cleaned AS text, {case(rules)} AS reason FROM {out}_w)"""


def fineweb(src: str, out: str, limits: FineWebQuality = FineWebQuality()) -> str:
    ended = f"len(list_filter(ls, lambda l: right(l, 1) IN ({quoted(LINE_END_PUNCTUATION)})))"
    short = f"len(list_filter(ls, lambda l: length(l) < {limits.short_line_chars}))"
    newlines = "(length(text) - length(replace(text, chr(10), '')))"
    rules = [
        ("empty", "len(ls) = 0"),
        ("line_punctuation", f"{share(ended, 'len(ls)')} <= {limits.min_line_punctuation}"),
        ("short_lines", f"{share(short, 'len(ls)')} >= {limits.max_short_lines}"),
        (
            "dup_line_chars",
            f"{dup_chars('ls', f'length(text) - {newlines}')} >= {limits.max_dup_line_chars}",
        ),
        ("list_like", f"{share(newlines, f'len({words('text')})')} > {limits.max_newline_ratio}"),
    ]
    return f"""
    {out}_w AS (SELECT id, text, {lines('text')} AS ls FROM {src}),
    {out} AS (SELECT id, text, {case(rules)} AS reason FROM {out}_w)"""


def language_profiles(src: str) -> str:
    """CTEs `profile`(lang, gram, n, total) and `grams`(id, gram) of `src`(id, text, lang)."""
    return f"""
    train_grams AS (
      SELECT lang, c[i] || c[i + 1] || c[i + 2] AS gram FROM (
        SELECT lang, c, unnest(range(1, len(c) - 1)) AS i FROM (
          SELECT lang, string_split(regexp_replace(lower(text), '[^\\p{{L}}]+', ' ', 'g'), '') AS c
          FROM {src}) WHERE len(c) >= 3)),
    gram_counts AS (SELECT lang, gram, count(*) AS n FROM train_grams GROUP BY ALL),
    profile AS (
      SELECT lang, gram, n, sum(n) OVER (PARTITION BY lang) AS total FROM gram_counts WHERE lang IS NOT NULL),
    known AS (SELECT DISTINCT gram FROM profile),
    langs AS (SELECT DISTINCT lang, total FROM profile),
    logs AS (
      SELECT l.lang, k.gram, ln((coalesce(p.n, 0) + 1.0) / (l.total + (SELECT count(*) FROM known)))
             AS logp
      FROM langs l CROSS JOIN known k LEFT JOIN profile p ON p.lang = l.lang AND p.gram = k.gram)"""


def language(src: str, out: str, target: str, min_score: float) -> str:
    """CTEs ending in `out`(id, text, language, score, reason); needs `language_profiles`."""
    return f"""
    {out}_g AS (
      SELECT id, c[i] || c[i + 1] || c[i + 2] AS gram, count(*) AS n FROM (
        SELECT id, c, unnest(range(1, len(c) - 1)) AS i FROM (
          SELECT id, string_split(regexp_replace(lower(text), '[^\\p{{L}}]+', ' ', 'g'), '') AS c
          FROM {src}) WHERE len(c) >= 3)
      GROUP BY ALL),
    {out}_s AS (
      SELECT id, lang, sum(g.n * logp) AS s FROM {out}_g g JOIN logs USING (gram) GROUP BY id, lang),
    {out}_m AS (SELECT *, max(s) OVER (PARTITION BY id) AS top FROM {out}_s),
    {out}_b AS (
      SELECT id, arg_max(lang, s) AS language, 1.0 / sum(exp(s - top)) AS score
      FROM {out}_m GROUP BY id),
    {out} AS (
      SELECT d.id, d.text, b.language, coalesce(b.score, 0.0) AS score,
             CASE WHEN b.language IS DISTINCT FROM '{target}' THEN 'language'
                  WHEN coalesce(b.score, 0.0) < {min_score} THEN 'language_score' END AS reason
      FROM {src} d LEFT JOIN {out}_b b ON b.id = d.id)"""


# Patterns for the page table, whose elements are closed and not nested in their like.
_SILENT = "(?is)<!--.*?(?:-->|\\z)|" + "|".join(rf"<{tag}\b.*?(?:</{tag}\s*>|\z)" for tag in sorted(html.SILENT))
_MAIN = r"(?is)<(?:article|main)\b[^>]*>(.*)</(?:article|main)\s*>"
_BLOCK = r"(?i)</?(?:" + "|".join(sorted(html.BLOCKS)) + r")\b[^>]*>"
_ANCHOR = r"(?is)<a\b[^>]*>.*?</a\s*>"
_TAG = r"<[a-zA-Z/!?][^>]*>"
_SPACE = r"[ \t\n\r\f\x{a0}]+"


def main_text(page: str) -> str:
    def sql(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    def plain(x: str) -> str:
        return (
            f"trim(regexp_replace(regexp_replace({x}, {sql(_TAG)}, '', 'g'), "
            f"{sql(_SPACE)}, ' ', 'g'))"
        )

    loud = f"regexp_replace({page}, {sql(_SILENT)}, ' ', 'g')"
    zone = f"regexp_extract({loud}, {sql(_MAIN)}, 1)"
    blocks = (
        f"regexp_split_to_array(CASE WHEN {zone} <> '' THEN {zone} ELSE {loud} END, "
        f"{sql(_BLOCK)})"
    )
    unlinked = plain(f"regexp_replace(b, {sql(_ANCHOR)}, '', 'g')")
    text = (
        f"array_to_string(list_transform(list_filter({blocks}, lambda b: "
        f"length({plain('b')}) >= {html.MIN_BLOCK_CHARS} AND "
        f"{share(f'length({plain('b')}) - length({unlinked})', f'length({plain('b')})')}"
        f" <= {html.MAX_LINK_SHARE!r}::DOUBLE), lambda b: {plain('b')}), chr(10))"
    )
    # The references that the page table has.
    for name, char in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·")):
        text = f"replace({text}, '{name}', {sql(char)})"
    return f"replace({text}, '&amp;', '&')"


def host(url: str) -> str:
    return f"lower(nullif(regexp_extract({url}, '^[a-zA-Z]+://([^/?#:]+)', 1), ''))"


def url_reason(url: str, domains: list[str], banned: list[str]) -> str:
    blocked = " OR ".join(
        f"{host(url)} = '{d}' OR ends_with({host(url)}, '.{d}')" for d in domains
    )
    return (
        f"CASE WHEN {blocked} THEN 'domain' WHEN regexp_matches(lower({url}), "
        f"'(^|[^a-z0-9])(?:{'|'.join(banned)})([^a-z0-9]|$)') THEN 'word' END"
    )
