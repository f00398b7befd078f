"""The chunker's fold in SQL, to compare the operator with: a state machine, one step a row, as a recursive query.

A state reads a line (header, too long, or added to what waits) or cuts one segment off an oversized text; a step emits
at most one chunk. Written from the rules alone, it shares nothing with the operator but white space and header.
"""

from __future__ import annotations

from lexquarry.functions.text import SPACE

NL = "chr(10)"


def _q(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {_q(f'^[{SPACE}]+|[{SPACE}]+$')}, '', 'g')"


def tokens(x: str) -> str:
    return f"((length({x}) + 3) // 4)"


def _left(x: str) -> str:
    return f"regexp_replace({x}, {_q(f'^[{SPACE}]+')}, '')"


def _right(x: str) -> str:
    return f"regexp_replace({x}, {_q(f'[{SPACE}]+$')}, '')"


def _join(x: str) -> str:
    return f"array_to_string({x}, {NL})"


def _line_ends(x: str) -> str:
    return f"(length({x}) - length(replace({x}, {NL}, '')))"


def _last(x: str, mark: str) -> str:
    """Where a mark stands last in a text, from 0; negative if nowhere."""
    return f"(length({x}) - length(list_extract(string_split({x}, {_q(mark)}), -1)) - {len(mark)})"


def _greatest(n: str, condition: str) -> str:
    """The greatest i from 1 to n that meets a condition, else 0."""
    return f"coalesce(list_max(list_filter(range(1, {n} + 1), lambda i: {condition})), 0)"


def _trimmed(x: str) -> str:
    last = _greatest(f"len({x})", f"{strip(f'({x})[i]')} <> ''")
    return f"({x})[1:{last}]"


def _overlap(x: str, most: int) -> str:
    fits = f"len(list_filter(range(1, len({x}) + 1), lambda k: list_sum(list_transform({x}[len({x}) - k + 1:], lambda y: {tokens('y')})) <= {most}))"
    return f"{x}[len({x}) - greatest(1, {fits}) + 1:]"


def _header(x: str) -> str:
    return "(" + " OR ".join(f"regexp_matches({x}, {_q(f'^={{{k}}}[{SPACE}]*[^=]+?[{SPACE}]*={{{k}}}[{SPACE}]*$')})" for k in range(2, 7)) + ")"


def _title(x: str) -> str:
    found = " || ".join(f"regexp_extract({x}, {_q(f'^={{{k}}}[{SPACE}]*([^=]+?)[{SPACE}]*={{{k}}}[{SPACE}]*$')}, 1)" for k in range(2, 7))
    return strip(f"({found})")


def chunks_sql(source: str, limit: int, overlap: int = 50) -> str:
    """CTEs (for WITH RECURSIVE) that end in ``made`` (doc_id, text, chunk_index, section, line_start, line_end, word_count,
    estimated_tokens), from a table ``source`` (doc_id, body) of texts without blanks around them."""
    window = limit * 3
    head, near = f"substr(rest, 1, {window + 50})", f"substr(rest, 1, {window})"
    cut = " ".join(f"WHEN {_last(head, p)} > 50 THEN {_last(head, p)} + 2" for p in (". ", "! ", "? "))
    cut = f"CASE {cut} WHEN {_last(near, ' ')} > 50 THEN {_last(near, ' ')} + 1 ELSE {window} END"
    blank = _greatest("j", f"{strip('tried[i]')} = ''")
    ended = _greatest("j", "regexp_matches(tried[i], " + _q(f"[.!?\"'][{SPACE}]*$") + ")")
    words = f"len(list_filter(regexp_split_to_array(e_text, {_q(f'[{SPACE}]+')}), lambda w: w <> ''))"
    return f"""
    src AS (SELECT doc_id, body, string_split(body, {NL}) AS lines FROM {source} WHERE body <> ''),
    begun AS (
        SELECT doc_id, lines, body, len(list_filter(lines, lambda x: {_header('x')})) > 0 AS headed, {tokens('body')} > {limit} AS much FROM src
    ),
    fold AS (
        -- a text without headers is one piece: cut if it is too much, else a chunk
        SELECT doc_id, 0::BIGINT AS step, CASE WHEN headed THEN 1 ELSE len(lines) + 1 END AS n, CASE WHEN headed OR much THEN []::VARCHAR[] ELSE lines END AS held,
               1::BIGINT AS begins, NULL::VARCHAR AS section, CASE WHEN NOT headed AND much THEN body END AS rest, CASE WHEN NOT headed AND much THEN body END AS whole,
               0::BIGINT AS place, NULL::VARCHAR AS prev, 1::BIGINT AS first, CASE WHEN NOT headed AND much THEN 'E' END AS why, false AS done,
               NULL::VARCHAR AS e_text, NULL::VARCHAR AS e_section, NULL::BIGINT AS e_first, NULL::BIGINT AS e_last
        FROM begun
        UNION ALL
        SELECT doc_id, step + 1,
               (CASE WHEN (s_done AND why IN ('H', 'line')) OR mode = 'A' OR (mode = 'H' AND NOT over) THEN n + 1 ELSE n END)::BIGINT,
               CASE WHEN (s_done AND why = 'H') OR (mode = 'H' AND NOT over) THEN list_append(carry, line)
                    WHEN (s_done AND why IN ('L', 'line')) OR (mode = 'L' AND NOT over) THEN []::VARCHAR[]
                    WHEN cutting THEN list_concat(carry, tried[cut2 + 1:]) WHEN mode = 'A' THEN tried ELSE held END,
               (CASE WHEN (s_done AND why = 'H') OR (mode = 'H' AND NOT over) THEN n - len(carry) WHEN s_done AND why = 'line' THEN n + 1
                     WHEN cutting THEN begins + cut2 - len(carry) ELSE begins END)::BIGINT,
               CASE WHEN (s_done AND why = 'H') OR (mode = 'H' AND NOT over) THEN {_title('line')} ELSE section END,
               CASE WHEN over THEN {_join('part')} WHEN enters THEN line WHEN mode = 'S' AND NOT s_done THEN left_over END,
               CASE WHEN over THEN {_join('part')} WHEN mode = 'S' AND NOT s_done THEN whole END,
               (CASE WHEN over OR enters THEN 0 WHEN s_keep AND why <> 'line' THEN found + length(seg) ELSE place END)::BIGINT,
               CASE WHEN over OR enters THEN NULL WHEN s_keep THEN seg ELSE prev END,
               (CASE WHEN over THEN begins ELSE first END)::BIGINT,
               CASE WHEN over THEN mode WHEN enters THEN 'line' ELSE why END,
               (mode = 'E' AND NOT over) OR (s_done AND why = 'E'),
               CASE WHEN s_keep THEN seg WHEN gives THEN {_join('part')} END,
               CASE WHEN s_keep OR gives THEN section END,
               (CASE WHEN s_keep AND why = 'line' THEN n WHEN s_keep THEN first + {_line_ends('substr(whole, 1, found::BIGINT)')} WHEN gives THEN begins END)::BIGINT,
               (CASE WHEN s_keep AND why = 'line' THEN n WHEN s_keep THEN first + {_line_ends('substr(whole, 1, (found + length(seg) - 1)::BIGINT)')} WHEN gives THEN begins + len(part) - 1 END)::BIGINT
        FROM (
            SELECT *, NOT over AND len(part) > 0 AND (cutting OR mode IN ('E', 'H', 'L')) AS gives, mode = 'L' AND len(held) = 0 AS enters,
                   CASE WHEN len(part) > 0 AND NOT over THEN {_overlap('part', overlap)} ELSE []::VARCHAR[] END AS carry,
                   CASE WHEN cutting THEN coalesce(list_min(list_filter(range(cut + 1, len(tried) + 1), lambda i: {strip('tried[i]')} <> '')), len(tried) + 1) - 1 END AS cut2
            FROM (
                SELECT *, mode IN ('E', 'H', 'L') AND {tokens(_join('part'))} > {limit} AS over
                FROM (
                    SELECT *, CASE WHEN cutting THEN {_trimmed('tried[1:cut]')} WHEN mode IN ('E', 'H', 'L') THEN {_trimmed('held')}
                                   WHEN s_done THEN string_split(coalesce(CASE WHEN s_keep THEN seg END, prev), {NL}) END AS part
                    FROM (
                        SELECT *, CASE WHEN NOT cutting THEN NULL WHEN j = len(tried) THEN j WHEN {blank} > 0 THEN {blank} WHEN {ended} > 0 THEN {ended} ELSE greatest(1, j) END AS cut,
                               CASE WHEN s_keep AND why <> 'line' THEN place + greatest(instr(substr(whole, (place + 1)::BIGINT), seg) - 1, 0) END AS found
                        FROM (
                            SELECT *, CASE WHEN cutting THEN len(list_filter(range(1, len(tried) + 1), lambda i: length({_join('tried[1:i]')}) <= {limit * 4})) END AS j,
                                   mode = 'S' AND seg <> '' AND (s_final OR seg IS DISTINCT FROM prev) AS s_keep, mode = 'S' AND left_over = '' AS s_done
                            FROM (
                                SELECT *, mode = 'A' AND {tokens(_join('tried'))} >= {limit} AS cutting,
                                       CASE WHEN mode <> 'S' THEN NULL WHEN s_final THEN {strip('rest')} ELSE {_right('substr(rest, 1, s_end)')} END AS seg,
                                       CASE WHEN mode <> 'S' THEN NULL WHEN s_final THEN '' ELSE {_left('substr(rest, s_end + 1)')} END AS left_over
                                FROM (
                                    SELECT *, CASE WHEN mode = 'A' THEN list_append(held, line) END AS tried, mode = 'S' AND length(rest) <= {window * 1.5} AS s_final,
                                           (CASE WHEN mode = 'S' THEN {cut} END)::BIGINT AS s_end
                                    FROM (
                                        SELECT f.*, s.lines[f.n] AS line,
                                               CASE WHEN f.rest IS NOT NULL THEN 'S' WHEN f.n > len(s.lines) THEN 'E' WHEN {_header('s.lines[f.n]')} THEN 'H'
                                                    WHEN {tokens('s.lines[f.n]')} > {limit} THEN 'L' ELSE 'A' END AS mode
                                        FROM fold f JOIN src s USING (doc_id) WHERE NOT f.done
                                    )
                                )
                            )
                        )
                    )
                )
            )
        )
    ),
    made AS (
        SELECT doc_id, e_text AS text, (row_number() OVER (PARTITION BY doc_id ORDER BY step) - 1)::INTEGER AS chunk_index, e_section AS section,
               e_first::INTEGER AS line_start, e_last::INTEGER AS line_end, {words}::INTEGER AS word_count, {tokens('e_text')}::INTEGER AS estimated_tokens
        FROM fold WHERE e_text IS NOT NULL
    )
    """
