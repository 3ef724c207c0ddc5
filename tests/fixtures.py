"""Small pages and responses the tests share."""

SITE = """<!doctype html>
<html lang="en"><head><meta charset="utf-8"><title>Harbour ferries</title>
<link rel="stylesheet" href="/f.css"><link rel="canonical" href="https://ferries.example.net/times"></head>
<body><section id="times" class="wide board"><h2>Sailings today</h2><p class="note">Bring a coat.</p>
<ol><li><a href="/quay7">North quay</a><li><a href="/quay12">Old pier</a><li><a href="/quay3">Lighthouse</a></ol>
</section><aside id="desk"><p>Desk open till nine</p></aside></body></html>"""

LIST = '<menu><li><a href="/tea">Tea</a></li> <li><a href="/milk">Milk</a></li> <li><a href="/rye">Rye</a></li></menu>'

LINKS = """<html><head><title>Orchard</title></head><body>
<header><a href="/trees">Trees</a><a href="/press">Press</a><a href="/visit">Visit</a></header>
<main><p>Try the <a href="/cider">cider</a> or see <a href="http://maps.example.org/road">the road</a>.</p></main>
<footer><map name="m"><area href="/plan" alt="Plan"></map><a href="/legal">Legal</a></footer></body></html>"""

SHOP = """<div class="product"><h2>One</h2><span class="price">1.50</span><a href="/p/1">see</a></div>
<div class="product"><h2>Two</h2><a href="/p/2">see</a><a href="/p/2b">more</a></div>
<div class="product"><h2>Three &amp; more</h2><span class="price">3</span></div>"""
