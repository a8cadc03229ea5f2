"""Schemas of the compiled tables and of the raw inputs."""

MONO = "struct<language: string, value: string, removed: string>"
DATAVALUE = (
    "struct<type: string, string: string, entityid: struct<entity_type: string, numeric_id: bigint>, "
    "globecoordinate: struct<latitude: double, longitude: double, altitude: double, precision: double, globe: string>, "
    "time: struct<time: string, timezone: bigint, precision: bigint, calendarmodel: string, before: bigint, after: bigint>, "
    "quantity: struct<amount: double, lowerBound: double, upperBound: double, unit: string>, monolingualtext: struct<language: string, value: string>>"
)
SNAK = f"struct<property: string, datatype: string, snaktype: string, datavalue: {DATAVALUE}>"
CLAIM = f"struct<id: string, type: string, rank: string, mainsnak: {SNAK}>"
ENTITY = f"id string, type string, labels map<string, {MONO}>, descriptions map<string, {MONO}>, aliases map<string, array<{MONO}>>, claims map<string, array<{CLAIM}>>, sitelinks map<string, struct<site: string, title: string>>"
PAGE = "id bigint, title string, ns int, model string, model_known boolean, kind string, text string, redirect string"

RAW_SNAK = "struct<property: string, datatype: string, snaktype: string, datavalue: struct<type: string, value: string>>"
RAW_ENTITY = f"id string, type string, labels map<string, {MONO}>, descriptions map<string, {MONO}>, aliases map<string, array<{MONO}>>, claims map<string, array<struct<id: string, type: string, rank: string, mainsnak: {RAW_SNAK}>>>, sitelinks map<string, struct<site: string, title: string>>, _corrupt_record string"
RAW_PAGE = "title string, ns int, id bigint, redirect struct<_title: string>, revision array<struct<id: bigint, model: string, text: string>>"

#: Fixed values of the dump formats.
ENTITY_TYPES = ["item", "property"]
CLAIM_TYPES = ["statement", "claim"]
VALUE_TYPES = ["string", "wikibase-entityid", "time", "quantity", "globecoordinate", "monolingualtext"]
RANKS = ["preferred", "normal", "deprecated"]
SNAKTYPES = ["value", "somevalue", "novalue"]
MODELS = ["wikitext", "wikibase-item", "css", "json", "flow-board", "javascript", "Scribunto", "MassMessageListContent"]
