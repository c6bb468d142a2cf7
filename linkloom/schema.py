"""Schemas of pages, links and updates."""

LINK = "STRUCT<url: STRING, uri: STRING, anchor_text: STRING>"
PAGE = f"url STRING, uri STRING, num_outbound BIGINT, crawl_date STRING, server STRING, title STRING, outbound_links ARRAY<{LINK}>"
#: Page documents as JSON lines name their fields in camel case.
PAGE_JSON = "url STRING, uri STRING, numInbound BIGINT, numOutbound BIGINT, crawlDate STRING, server STRING, title STRING, outboundLinks ARRAY<STRUCT<url: STRING, uri: STRING, anchorText: STRING>>"
UPDATE = f"uri STRING, op STRING, ts TIMESTAMP, page STRUCT<url: STRING, uri: STRING, num_outbound: BIGINT, crawl_date: STRING, server: STRING, title: STRING, outbound_links: ARRAY<{LINK}>>"
