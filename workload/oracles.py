"""The same answers in DuckDB SQL, by regular expressions over the raw markup.

Nothing here parses: these are a second, independent way to the same rows, which
works because the ``pages`` table's markup is regular.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}


def decoded(x: str) -> str:
    """The entities that occur in titles, headings, links and list items."""
    return f"regexp_replace(replace({x},'&quot;','\"'),'&amp;?','&','g')"


TITLE = decoded("regexp_extract(html,'<title>([^<]*)</title>',1)")
H1 = decoded("regexp_extract(html,'<h1>([^<]*)</h1>',1)")
AD = decoded("regexp_extract(html,'<div class=\"ad\">([^<]*)</div>',1)")
LANG = "regexp_extract(html,'<html lang=\"([^\"]*)\"',1)"
FOOTER = "regexp_extract(html,'<footer>([^<]*)',1)"
FOOTER_TEXT = "replace(replace(" + decoded(FOOTER) + ",'&copy;','©'),'&middot;','·')"


def n(pattern: str) -> str:
    return f"CAST(len(regexp_extract_all(html,'{pattern}')) AS INTEGER)"


# Every <a href> of a page: its place, target and text.
ANCHORS = f"""
m AS (SELECT page_id, url AS page_url, unnest(l) AS tag, generate_subscripts(l,1)-1 AS pos
      FROM (SELECT page_id, url, regexp_extract_all(html,'<a href="[^"]*">[^<]*</a>') AS l FROM pages)),
a AS (SELECT page_id, page_url, CAST(pos AS INTEGER) AS pos, {decoded("regexp_extract(tag,'href=\"([^\"]*)\"',1)")} AS href,
      {decoded("regexp_extract(tag,'>([^<]*)<',1)")} AS text FROM m)"""

# Percent-encoding keeps more than url_encode does.
ENCODED = "replace(replace(replace(url_encode({0}),'%2C',','),'%2F','/'),'%25','%')"
RESOLVED = ANCHORS + f""",
r AS (SELECT page_id, page_url, pos, text,
      regexp_extract(page_url,'^(https?://[^/]+)',1)||'/'||{ENCODED.format("substr(href,2)")} AS url FROM a)"""
UNIQUE = RESOLVED + """,
u AS (SELECT *, row_number() OVER (PARTITION BY page_id, url ORDER BY pos) AS k FROM r),
d AS (SELECT page_id, page_url, text, url, CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos)-1 AS INTEGER) AS pos FROM u WHERE k=1)"""


# -- the pages of links that workload.inputs.link_pages derives --------------------
# bare: URL without query and fragment; top: its origin; up: the folder above.

# Links of the page itself come first, at places below zero.
DERIVED = RESOLVED + """,
b AS (SELECT page_id, url, regexp_replace(url,'[?#].*','') AS bare, regexp_extract(url,'^(https?://[^/]+)',1) AS top FROM pages),
f AS (SELECT *, regexp_replace(substr(bare,length(top)+1),'[^/]*$','') AS folder FROM b),
g AS (SELECT *, top||regexp_replace(folder,'[^/]+/$','') AS parent FROM f),
c(page_id, page_url, pos, tag, attr, value, url, text, nofollow) AS (
  SELECT a.page_id, a.page_url, a.pos-1000000, 'a', 'href', a.href, r.url, a.text, false FROM a JOIN r ON r.page_id=a.page_id AND r.pos=a.pos
  UNION ALL SELECT page_id, url, 0, 'a', 'href', url, url, 'as is', false FROM g
  UNION ALL SELECT page_id, url, 1, 'a', 'href', '../up?b=2&a=1#frag', parent||'up?b=2&a=1#frag', 'up', true FROM g
  UNION ALL SELECT page_id, url, 2, 'a', 'href', bare||'/report.PDF', bare||'/report.PDF', 'file', false FROM g
  UNION ALL SELECT page_id, url, 3, 'a', 'href', 'mailto:x@example.com', 'mailto:x@example.com', 'mail', false FROM g
  UNION ALL SELECT page_id, url, 4, 'a', 'href', NULL, NULL, 'none', false FROM g
  UNION ALL SELECT page_id, url, 5, 'a', 'href', '  '||url||chr(10), url, 'padded', false FROM g
  UNION ALL SELECT page_id, url, 6, 'area', 'href', bare||'?a=1&b=2', bare||'?a=1&b=2', '', false FROM g
  UNION ALL SELECT page_id, url, 7, 'link', 'href', '/style.css', top||'/style.css', '', false FROM g
  UNION ALL SELECT page_id, url, 8, 'a', 'href', 'http://[bad', NULL, 'bad', false FROM g
  UNION ALL SELECT page_id, url, 9, 'a', 'href', '', url, 'self', false FROM g
  UNION ALL SELECT page_id, url, 10, 'a', 'data-url', '/data/'||page_id, top||'/data/'||page_id, 'self', false FROM g
  UNION ALL SELECT page_id, url, 11, 'a', 'href', '../up?a=1&b=2', parent||'up?a=1&b=2', 'twin', false FROM g)"""

DEFAULT_DENY = "NOT regexp_matches(lower(regexp_extract(url,'^[a-z]+://[^/?#]*([^?#]*)',1)),'[.](pdf|css|js|py|jpg|zip)$')"
WEB = "regexp_matches(url,'^(https?|ftp|file)://')"
HOST = "lower(regexp_extract(url,'^[a-z]+://([^/?#]*)',1))"


def derived(where: str, *, columns: str = "page_id, pos, url", unique: bool = True, scan: str = "tag IN ('a','area') AND attr='href'",
            url: str = "url", key: str = "url") -> str:
    """Scan, resolve, keep the first per key, filter, number again."""
    first = f"QUALIFY row_number() OVER (PARTITION BY page_id, {key} ORDER BY pos)=1" if unique else ""
    return f"""WITH {DERIVED},
s AS (SELECT page_id, page_url, pos, {url} AS url, text, nofollow FROM c WHERE {scan} AND c.url IS NOT NULL),
q AS (SELECT * FROM s WHERE url IS NOT NULL {first}),
o AS (SELECT page_id, page_url, url, text, nofollow,
      CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos)-1 AS INTEGER) AS pos FROM q WHERE {WEB} AND {where})
SELECT {columns} FROM o"""


O = ORACLES

O["page_scan"] = "SELECT page_id, url, CAST(length(html) AS INTEGER) AS n_chars FROM pages"

KIND = """CASE WHEN host LIKE 'www.%' THEN 'xml' WHEN host LIKE 'm.%' THEN 'html' WHEN host LIKE 'blog.%' THEN 'html'
WHEN url LIKE 'https://%' THEN 'text' ELSE 'html' END"""
KINDS = f"k AS (SELECT *, {KIND} AS kind FROM (SELECT *, regexp_extract(url,'^https?://([^/]+)',1) AS host FROM pages))"
O["response_text"] = f"WITH {KINDS} SELECT page_id, url, md5(html) AS digest FROM k WHERE kind='html'"
O["response_gunzip"] = O["response_text"]
O["response_cut"] = "SELECT page_id, true AS is_whole, true AS is_packed FROM pages"
O["sink_roundtrip"] = f"WITH {UNIQUE} SELECT page_id, pos, url FROM d"
O["parse_tag_counts"] = f"""SELECT page_id, {n('<p>')} AS n_p, {n('<br>')} AS n_br, {n('<li>')} AS n_li, {n('<a href=')} AS n_a,
{n('<div ')} AS n_div, {n('<meta ')} AS n_meta, {n('<script>')} AS n_script, {n('<h1>')} AS n_h1 FROM pages"""
# An unclosed <b> is reopened, three alike at most, in every later piece of the page that holds text.
REOPENED = """plain AS (SELECT page_id, regexp_replace(regexp_replace(html,'<script>.*</script>|<style>[^<]*</style>','','g'),'<!--.*?-->','','g') AS h FROM pages),
cuts AS (SELECT page_id, regexp_replace(h,'(<p>|</p>|</article>|<footer>)',chr(1)||'\\1','g') AS h FROM plain),
pieces AS (SELECT page_id, unnest(string_split(h,chr(1))) AS piece, generate_subscripts(string_split(h,chr(1)),1) AS k FROM cuts),
marks AS (SELECT page_id, k, regexp_replace(piece,'<[^>]*>','','g')<>'' AS holds, len(regexp_extract_all(piece,'<b>')) AS written FROM pieces),
seen AS (SELECT *, coalesce(sum(written) OVER (PARTITION BY page_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),0) AS before FROM marks),
bold AS (SELECT page_id, CAST(sum(written+CASE WHEN holds THEN least(3,before) ELSE 0 END) AS BIGINT) AS n FROM seen GROUP BY page_id)"""
O["node_rows"] = f"""WITH {REOPENED} SELECT page_id, tag, CAST(depth AS INTEGER) AS depth, len(regexp_extract_all(h, '<'||tag||'[ >]')) AS n
FROM (SELECT p.page_id, regexp_replace(html,'<script>.*</script>','<script>') AS h FROM pages p),
(VALUES ('html',0),('head',1),('meta',2),('title',2),('style',2),('script',2),('body',1),('nav',2),('ul',3),('li',4),('a',5),('div',2),('article',2),('h1',3),('p',3),('br',NULL),('footer',2)) t(tag,depth)
WHERE regexp_matches(h, '<'||tag||'[ >]') UNION ALL SELECT page_id, 'b', NULL, n FROM bold WHERE n>0"""
O["formatting_reopened"] = "SELECT page_id, 80 AS n_inside, 'two' AS innermost FROM pages"
O["node_siblings"] = f"""SELECT page_id, CAST(unnest(range(1, k+1)) AS INTEGER) AS sib, CAST(k AS INTEGER) AS nsib, 1 AS n_below
FROM (SELECT page_id, {n('<li>')} AS k FROM pages)"""
O["parse_null_pages"] = f"""SELECT page_id, url LIKE '%?%' AS is_empty, CASE WHEN url LIKE '%?%' THEN 'none' ELSE {H1} END AS h1 FROM pages"""
O["stored_docs_reuse"] = f"SELECT page_id, {TITLE} AS title, {H1} AS h1, {n('<li>')} AS n_li, {n('<a href=')} AS n_nav_links FROM pages"

O["route_kinds"] = f"WITH {KINDS} SELECT page_id, kind, kind='html' AS is_html FROM k"
O["route_split"] = f"""WITH {KINDS} SELECT CASE WHEN kind='html' THEN 'html' ELSE 'other' END AS branch, kind, count(*) AS n
FROM k GROUP BY ALL"""
O["route_overrides"] = f"""WITH {KINDS}, s AS (SELECT page_id, kind, url LIKE '%?%' AS has,
CASE WHEN url LIKE '%utm_source%' THEN true ELSE false END AS chosen FROM k)
SELECT page_id, d AS "default", kind='html' AND CASE WHEN has THEN chosen ELSE d='on' END AS is_html
FROM s, (VALUES ('on'),('off')) v(d)"""
O["route_html_links"] = f"""WITH {KINDS}, {UNIQUE} SELECT d.page_id, count(*) AS n_links FROM d JOIN k USING (page_id) WHERE kind='html' GROUP BY ALL"""
O["nonempty_filter"] = f"SELECT page_id, {AD} AS ad FROM pages WHERE {AD}<>''"

O["select_tag"] = f"SELECT page_id, 0 AS pos, 'h1' AS tag, {H1} AS value FROM pages"
O["select_id"] = f"SELECT page_id, 0 AS pos, {H1} AS value FROM pages"
O["select_class"] = f"SELECT page_id, 0 AS pos, 'div' AS tag, {AD} AS value FROM pages"
O["select_compound"] = f"SELECT page_id, 0 AS pos, {AD} AS value FROM pages"
O["select_attr_present"] = f"""SELECT page_id, {n('<a href=')} AS n_href, {n('<html lang=')} AS n_lang, {n('<a [^>]*rel=')} AS n_rel,
{n('<meta charset=')} AS n_charset FROM pages"""
O["select_attr_equals"] = f"SELECT page_id, 0 AS pos, {TITLE} AS value FROM pages WHERE {LANG}='en'"
O["select_attr_operators"] = f"""SELECT page_id, {n('<a href="/a[^"]*"')} AS n_prefix, {n('<a href="[^"]*,"')} AS n_suffix,
{n('<a href="[^"]*th[^"]*"')} AS n_inside, CAST({LANG}='en' AS INTEGER) AS n_lang, {n('<a href="/(?i:the)"')} AS n_folded FROM pages"""
O["select_descendant"] = f"WITH {ANCHORS} SELECT page_id, pos, text AS value FROM a"
O["select_child"] = f"SELECT page_id, {n('<li>')} AS n_li, 0 AS n_none, {n('<a href=')} AS n_chain, {H1} AS h1 FROM pages"
O["select_siblings"] = f"""SELECT p.page_id, {AD} AS after_nav, greatest({n('<li>')}-1,0) AS n_next, {n('<p>')} AS n_later, a.text AS first_li,
CAST(({n('<li>')}+1)//2 AS INTEGER) AS n_odd, least({n('<li>')},1) AS n_last, greatest({n('<li>')}-1,0) AS n_not_first
FROM pages p LEFT JOIN (WITH {ANCHORS} SELECT page_id, text FROM a WHERE pos=0) a ON a.page_id=p.page_id"""
TH = "contains(href,'th')"
PLACED = "CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos)-1 AS INTEGER)"
O["select_has"] = f"""WITH {ANCHORS}, s AS (SELECT *, lead(href) OVER (PARTITION BY page_id ORDER BY pos) AS after FROM a)
SELECT page_id, {PLACED} AS pos, text AS value, 'child' AS form FROM s WHERE {TH}
UNION ALL SELECT page_id, {PLACED}, text, 'deep' FROM s WHERE {TH}
UNION ALL SELECT page_id, {PLACED}, text, 'none' FROM s WHERE NOT {TH}
UNION ALL SELECT page_id, {PLACED}, text, 'before' FROM s WHERE contains(after,'th')
UNION ALL SELECT page_id, 0, CASE form WHEN 'any' THEN '2' WHEN 'not child' THEN '0' ELSE '1' END, form FROM pages, (VALUES ('chain'), ('later'), ('not child'), ('any')) f(form)"""
O["select_of_type"] = f"""WITH {ANCHORS}, s AS (SELECT *, count(*) OVER (PARTITION BY page_id) AS n FROM a),
l AS (SELECT page_id, text, n, pos, CASE WHEN pos=0 THEN 1 ELSE pos END AS place, n - CASE WHEN n>1 THEN 1 ELSE 0 END AS n_left FROM s WHERE pos<>1)
SELECT page_id, CAST(pos//2 AS INTEGER) AS pos, text AS value, 'odd' AS form FROM s WHERE pos%2=0
UNION ALL SELECT page_id, 0, text, 'third from the end' FROM s WHERE pos=n-3
UNION ALL SELECT page_id, 0, text, 'first' FROM s WHERE pos=0
UNION ALL SELECT page_id, 0, text, 'last' FROM s WHERE pos=n-1
UNION ALL SELECT page_id, 0, {H1}, 'only' FROM pages
UNION ALL SELECT page_id, 0, text, 'dropped' FROM l WHERE place=2
UNION ALL SELECT page_id, CASE WHEN n_left>=2 THEN 1 ELSE 0 END, text, 'dropped' FROM l WHERE place=n_left"""
O["select_comma_list"] = f"""SELECT page_id, 0 AS pos, 'h1' AS tag, {H1} AS value FROM pages
UNION ALL SELECT page_id, 1, 'title', {TITLE} FROM pages UNION ALL SELECT page_id, 2, 'html', {LANG} FROM pages"""
O["select_scoped"] = f"""WITH {ANCHORS} SELECT page_id, CAST(2*pos AS INTEGER) AS pos, href AS value FROM a
UNION ALL SELECT page_id, CAST(2*pos+1 AS INTEGER), text FROM a"""
O["select_self"] = O["select_descendant"]
O["page_css"] = f"SELECT page_id, {TITLE} AS title, 1 AS n_footer FROM pages"

O["project_text"] = f"""SELECT page_id, {TITLE} AS title,
coalesce((WITH {ANCHORS} SELECT string_agg(text,'' ORDER BY pos) FROM a WHERE a.page_id=p.page_id),'') AS nav, {{br}} AS br,
regexp_extract(html,'<style>([^<]*)',1) AS style, regexp_extract(html,'<script>(.*)</script>',1) AS script FROM pages p""".replace(
    "{br}", "CASE WHEN html LIKE '%<br>%' THEN '' END")
O["project_attr"] = f"""WITH {ANCHORS} SELECT page_id, 0 AS pos, {LANG} AS value FROM pages
UNION ALL SELECT page_id, CAST(pos+1 AS INTEGER), '' FROM a
UNION ALL SELECT page_id, {n('<a href=')}+1, 'utf-8' FROM pages"""
O["project_html"] = f"""SELECT page_id, replace({decoded("regexp_extract(html,'(<nav>.*</nav>)',1)")},'&','&amp;') AS nav,
'<meta charset="utf-8">' AS meta, '<style>p{{margin:0}}</style>' AS style, '<h1>'||replace({H1},'&','&amp;')||'</h1>' AS h1 FROM pages"""
O["project_attrib"] = f"""SELECT p.page_id, {LANG} AS lang, a.href AS href, CASE WHEN a.href IS NULL THEN 0 ELSE 1 END AS n_a, 0 AS n_none
FROM pages p LEFT JOIN (WITH {ANCHORS} SELECT page_id, href FROM a WHERE pos=0) a ON a.page_id=p.page_id"""
O["project_link_parts"] = f"""WITH {DERIVED} SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos)-1 AS INTEGER) AS pos,
attr, value, text, nofollow FROM c WHERE tag IN ('a','area')"""

O["array_getall"] = f"""SELECT page_id, coalesce((WITH {ANCHORS} SELECT string_agg(text,'|' ORDER BY pos) FROM a WHERE a.page_id=p.page_id),'') AS joined
FROM pages p"""
O["array_get_default"] = f"""SELECT page_id, {H1} AS h1, 'none' AS zz, CAST(NULL AS VARCHAR) AS zz_null,
CASE WHEN html LIKE '%<br>%' THEN '' ELSE 'none' END AS br FROM pages"""
LISTS = f"{ANCHORS}, t AS (SELECT p.page_id, coalesce(list(text ORDER BY pos) FILTER (text IS NOT NULL),[]) AS l FROM pages p LEFT JOIN a USING (page_id) GROUP BY p.page_id)"
O["array_index"] = f"WITH {LISTS} SELECT page_id, l[1] AS first, l[-1] AS last, l[2] AS second, l[501] AS beyond FROM t"
O["array_slice"] = f"""WITH {LISTS} SELECT page_id, array_to_string(l[2:3],'|') AS mid,
array_to_string(CASE WHEN len(l)<2 THEN l ELSE l[len(l)-1:len(l)] END,'|') AS tail, array_to_string(l[1:len(l)-1],'|') AS but_last, 0 AS n_empty FROM t"""
O["array_flatten"] = f"""WITH {ANCHORS}, k AS (SELECT page_id, count(*) AS n FROM a GROUP BY page_id)
SELECT page_id, CAST(pos+i*n AS INTEGER) AS pos, text AS value FROM a JOIN k USING (page_id), (VALUES (0),(1)) t(i)"""
O["array_rows"] = f"WITH {ANCHORS} SELECT page_id, CAST(pos AS INTEGER) AS pos, 'li' AS tag, '<li>'||tag||'</li>' AS value FROM m"
O["array_count"] = f"SELECT page_id, {n('<li>')} AS n_li, 0 AS n_zz FROM pages"

MATCHES = f"SELECT page_id, unnest(l) AS m, generate_subscripts(l,1)-1 AS i FROM (SELECT page_id, regexp_extract_all({H1},'[A-Za-z]+ [a-z]+') AS l FROM pages)"
O["regex_all"] = f"""WITH x AS ({MATCHES}) SELECT page_id, CAST(2*i AS INTEGER) AS pos, regexp_extract(m,'^([A-Za-z]+)',1) AS value, 'h1' AS source FROM x
UNION ALL SELECT page_id, CAST(2*i+1 AS INTEGER), regexp_extract(m,' ([a-z]+)$',1), 'h1' FROM x
UNION ALL SELECT page_id, i, v, 'script' FROM pages, (VALUES (0,'7'),(1,'t="'),(2,'DATA={{')) s(i,v)"""
O["regex_one_group"] = f"""WITH {ANCHORS}, x AS (SELECT page_id, pos, regexp_extract(href,'/(th[a-z]*)',1) AS value FROM a WHERE regexp_matches(href,'/th'))
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos)-1 AS INTEGER) AS pos, value FROM x"""
O["regex_first"] = f"""SELECT page_id, CASE WHEN regexp_matches({H1},'[a-z]{{5,}}') THEN regexp_extract({H1},'[a-z]{{5,}}') ELSE 'none' END AS word,
nullif(regexp_extract({H1},'([A-Z])[a-z]+',1),'') AS initial,
CASE WHEN regexp_matches({H1},'[0-9]{{7}}') THEN regexp_extract({H1},'[0-9]{{7}}') ELSE 'none' END AS number FROM pages"""
O["entity_decode"] = """SELECT page_id, md5(replace(replace(replace(html,'&copy;','©'),'&middot;','·'),'&quot;','"')) AS digest FROM pages"""
O["strip_blank_values"] = "SELECT page_id, md5(trim(html, ' '||chr(9)||chr(10)||chr(12)||chr(13))) AS digest FROM pages"
O["rel_tokens"] = f"WITH {ANCHORS} SELECT page_id, pos, page_url LIKE '%spam%' AS nofollow, false AS absent FROM a"

O["drop_subtrees"] = f"""SELECT page_id, '<head><meta charset="utf-8"><title>'||replace({TITLE},'&','&amp;')||'</title>'
||regexp_extract(html,'(<script>.*</script>)',1)||'</head>' AS head, 0 AS n_a,
'<footer>'||repeat('<b>',least(3,{n('<b>')}))||replace({FOOTER_TEXT},'&','&amp;')||repeat('</b>',least(3,{n('<b>')}))||'</footer>' AS first,
1 AS n_last, 1+least(3,{n('<b>')}) AS n_left FROM pages"""
O["drop_indexed"] = f"""WITH {LISTS} SELECT page_id, array_to_string(l[2:len(l)-2],'|') AS left, CASE WHEN len(l) BETWEEN 1 AND 3 THEN 1 ELSE 0 END AS n_empty FROM t"""
O["drop_scoped"] = f"""WITH {LISTS} SELECT page_id, array_to_string(list_transform(range(2,len(l)+1,2), lambda i: l[i]),'|') AS left,
CAST((len(l)+1)//2 AS INTEGER) AS n_empty, 0 AS n_h1 FROM t"""
O["drop_keeps_input"] = f"""WITH {ANCHORS} SELECT p.page_id, {n('<li>')} AS n_before, greatest({n('<li>')}-1,0) AS n_after, a.text AS new_first
FROM pages p LEFT JOIN (SELECT page_id, text FROM a WHERE pos=1) a ON a.page_id=p.page_id"""
O["page_clean_text"] = f"SELECT page_id, {TITLE}||{FOOTER_TEXT} AS text FROM pages"

O["link_scan"] = f"WITH {ANCHORS} SELECT page_id, pos, 'href' AS attr, href AS value, text FROM a"
O["link_resolve"] = f"WITH {RESOLVED} SELECT page_id, pos, url, text, false AS nofollow FROM r"
O["link_unique"] = f"WITH {UNIQUE} SELECT page_id, pos, url, text, false AS nofollow FROM d"
O["link_options_default"] = derived(DEFAULT_DENY, columns="page_id, pos, url, text, nofollow", unique=False)
O["link_no_strip"] = derived(DEFAULT_DENY)
O["link_base"] = f"""WITH {ANCHORS} SELECT page_id, pos,
regexp_extract(page_url,'^(https?://[^/]+)',1)||'/deep/er/'||{ENCODED.format("substr(href,2)")} AS url FROM a"""
O["link_process_value"] = derived(DEFAULT_DENY, columns="page_id, pos, url, text", url="regexp_replace(url,'[?#].*','')",
                                  scan="tag IN ('a','area') AND attr='href' AND url NOT LIKE 'mailto:%'")
O["link_process_udf"] = f"SELECT p.*, form FROM ({O['link_process_value']}) p, (VALUES ('string'), ('series'), ('array')) f(form)"
O["link_normalise"] = f"""WITH {ANCHORS} SELECT page_id, pos, regexp_extract(page_url,'^(https?://[^/]+)',1)||'/x%20y%7C'
||{ENCODED.format("substr(href,2)")}||'?q=%27'||{ENCODED.format("substr(href,2)")}||'%27' AS url FROM a"""
O["link_allow"] = derived("regexp_matches(url,'/en/|[?]a=1')")
O["link_deny"] = derived("NOT regexp_matches(url,'/en/|[?]b=')")
O["link_allow_domains"] = derived(DEFAULT_DENY + f" AND (regexp_matches({HOST},'(^|[.])example[.]com$') OR regexp_matches({HOST},'(^|[.])m[.]ththth[.]example[.]net$'))")
O["link_deny_domains"] = derived(DEFAULT_DENY + f" AND NOT regexp_matches({HOST},'(^|[.])example[.]com$')")
# Filters come after numbering in restrict_domains, so the places are those before it.
O["link_domain_table"] = f"""WITH l AS ({derived(DEFAULT_DENY)}), z AS (SELECT DISTINCT regexp_extract(url,'([^./]+[.]example[.][a-z]+)',1) AS dom
FROM pages WHERE regexp_matches(url,'spam|pills'))
SELECT page_id, pos, url FROM l WHERE NOT EXISTS (SELECT 1 FROM z WHERE {HOST}=z.dom OR {HOST} LIKE '%.'||z.dom)"""
O["stream_domain_table"] = f"""WITH l AS ({derived(DEFAULT_DENY)}), z AS (SELECT DISTINCT regexp_extract(url,'([^./]+[.]example[.][a-z]+)',1) AS dom
FROM pages WHERE contains(url,'/en/'))
SELECT page_id, pos, url FROM l WHERE EXISTS (SELECT 1 FROM z WHERE {HOST}=z.dom OR ends_with({HOST}, '.'||z.dom))"""
O["link_deny_extensions"] = derived("NOT regexp_matches(lower(regexp_extract(url,'^[a-z]+://[^/?#]*([^?#]*)',1)),'[.]html?$')")
O["link_schemes"] = f"""SELECT page_id, regexp_extract(url,'^([a-z]+):',1) AS scheme, count(*) AS n FROM ({derived('true')}) GROUP BY ALL"""
# Query strings here hold two pairs at most; sorting them is swapping them.
SORTED = "regexp_replace(regexp_replace({0},'#.*',''),'[?](b=2)&(a=1)$','?\\2&\\1')"
KEY = "regexp_replace(url,'[?](b=2)&(a=1)','?\\2&\\1')"
O["link_canonical"] = f"""WITH i AS ({derived(DEFAULT_DENY, columns='page_id, pos, url, text', key=KEY)}),
j AS (SELECT page_id, pos, text, {SORTED.format('url')} AS url FROM i)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos)-1 AS INTEGER) AS pos, url, text
FROM (SELECT * FROM j QUALIFY row_number() OVER (PARTITION BY page_id, url ORDER BY pos)=1)"""
O["link_tags_attrs"] = derived("true", unique=False, scan="tag IN ('a','link')")

O["records"] = f"""WITH {ANCHORS} SELECT page_id, pos, text AS label, href, CAST(NULL AS VARCHAR) AS missing,
CASE WHEN regexp_matches(text,'[a-z]{{4,}}') THEN regexp_extract(text,'[a-z]{{4,}}') ELSE 'none' END AS word FROM a"""
O["page_fields"] = f"""SELECT page_id, url, {TITLE} AS title, {H1} AS h1, CAST(NULL AS VARCHAR) AS price, {LANG} AS lang,
CASE WHEN regexp_matches({H1},'^[\\pL\\pN_]') THEN regexp_extract({H1},'^([\\pL\\pN_]+)',1) ELSE 'none' END AS first_word FROM pages"""
O["crawl_rules"] = f"""WITH {UNIQUE}, e AS (SELECT *, CASE WHEN regexp_matches(url,'/th') THEN 0 WHEN regexp_matches(url,'/[a-z]{{1,3}}$') THEN 1
WHEN NOT regexp_matches(url,'%') THEN 2 END AS rule FROM d)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY rule, pos)-1 AS INTEGER) AS pos, CAST(rule AS INTEGER) AS rule,
CASE rule WHEN 0 THEN 'parse_th' WHEN 1 THEN 'parse_short' END AS callback, rule<>1 AS follow, url, text, false AS nofollow
FROM e WHERE rule IS NOT NULL"""
O["crawl_frontier"] = f"""WITH {UNIQUE} SELECT DISTINCT url FROM d WHERE regexp_matches(url,'/th')
AND NOT EXISTS (SELECT 1 FROM d s WHERE s.pos=0 AND s.url=d.url)"""
O["crawl_rounds"] = f"""WITH {UNIQUE}, new AS (SELECT DISTINCT url FROM d WHERE NOT EXISTS (SELECT 1 FROM d s WHERE s.pos=0 AND s.url=d.url))
SELECT url, CASE WHEN contains(url,'/th') THEN 1 ELSE 2 END::INTEGER AS round FROM new"""
O["links_per_host"] = f"""WITH {RESOLVED} SELECT regexp_extract(page_url,'^https?://([^/:]+)',1) AS src_host, count(DISTINCT page_id) AS n_pages,
count(*) AS n_links, count(DISTINCT url) AS n_targets FROM r GROUP BY ALL"""
GRAPH = f"""SELECT regexp_extract(page_url,'^https?://([^/:]+)',1) AS src_host, regexp_extract(url,'^https?://([^/:]+)',1) AS dst_host,
count(*) AS n_links, count(DISTINCT url) AS n_urls, avg(CAST(nofollow AS INTEGER)) AS nofollow_share
FROM ({derived(DEFAULT_DENY, columns='page_url, url, nofollow')}) GROUP BY ALL"""
O["host_graph"] = GRAPH
# Pages whose number leaves the rest 2 are in both crawls.
O["host_graph_merged"] = f"""SELECT src_host, dst_host, CAST(sum(n) AS BIGINT) AS n_links, true AS is_close FROM (
SELECT regexp_extract(page_url,'^https?://([^/:]+)',1) AS src_host, regexp_extract(url,'^https?://([^/:]+)',1) AS dst_host, CASE WHEN page_id % 3 = 2 THEN 2 ELSE 1 END AS n
FROM ({derived(DEFAULT_DENY, columns='page_id, page_url, url')})) GROUP BY ALL"""
O["host_graph_degrees"] = f"""WITH e AS ({GRAPH}) SELECT host, CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i) AS BIGINT) AS in_degree FROM
(SELECT src_host AS host, 1 AS o, 0 AS i FROM e UNION ALL SELECT dst_host, 0, 1 FROM e) GROUP BY host"""
O["most_linked"] = f"WITH {RESOLVED} SELECT url, count(*) AS n_links FROM r GROUP BY url ORDER BY n_links DESC, url LIMIT 20"
O["tag_frequency"] = f"""WITH {REOPENED},
t AS (SELECT page_id, unnest(regexp_extract_all(regexp_replace(html,'<script>.*</script>','<script>'),'<([a-z][a-z0-9]*)[ >]',1)) AS tag FROM pages),
k AS (SELECT page_id, tag, count(*) AS n FROM t WHERE tag<>'b' GROUP BY ALL UNION ALL SELECT page_id, 'b', n FROM bold WHERE n>0)
SELECT tag, CAST(sum(n) AS BIGINT) AS n_elements, count(*) AS n_pages FROM k GROUP BY tag"""
O["tag_pages_merged"] = f"SELECT tag, n_pages AS exact, true AS is_close FROM ({O['tag_frequency']})"
O["attribute_frequency"] = f"""SELECT attribute, CAST(sum(k) AS BIGINT) AS n_elements, count(*) AS n_pages FROM (
SELECT page_id, 'a.href' AS attribute, {n('<a href=')} AS k FROM pages UNION ALL SELECT page_id, 'html.lang', {n('<html lang=')} FROM pages
UNION ALL SELECT page_id, 'meta.charset', {n('<meta charset=')} FROM pages UNION ALL SELECT page_id, 'div.class', {n('<div class=')} FROM pages)
WHERE k>0 GROUP BY attribute"""

O["scan_predicates"] = """SELECT page_id, 0 AS pos, 'rel' AS attr, 'noopener,nofollow' AS value FROM pages
UNION ALL SELECT page_id, 1, 'data-url', '/data/'||page_id FROM pages"""
O["page_callback"] = f"""WITH {UNIQUE} SELECT p.page_id, {H1} AS name, CAST(coalesce(k,0) AS INTEGER) AS n_links
FROM pages p LEFT JOIN (SELECT page_id, count(*) AS k FROM d GROUP BY page_id) USING (page_id)"""
O["links_in_scope"] = f"WITH {ANCHORS} SELECT page_id, CAST(pos-1 AS INTEGER) AS pos, text FROM a WHERE pos>0"

O["stream_page_links"] = O["link_unique"]
O["stream_page_records"] = f"WITH {ANCHORS} SELECT page_id, pos, text AS label, href FROM a"
O["stream_routing"] = f"WITH {KINDS} SELECT url, md5(html) AS digest FROM k WHERE kind='html'"
O["stream_three_tables"] = f"""WITH {UNIQUE}, {KINDS},
h AS (SELECT page_id FROM k WHERE kind='html')
SELECT 'links' AS part, page_id, pos, url AS value FROM d JOIN h USING (page_id)
UNION ALL SELECT 'records', page_id, pos, text||' '||href FROM a JOIN h USING (page_id)
UNION ALL SELECT 'skipped', page_id, 0, kind FROM k WHERE kind<>'html'"""
