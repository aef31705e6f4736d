"""End-to-end answers (``pageviews``, ``keyed_pageviews``, ``workforce``,
``clustering``, ``text``), their inputs (``fixtures``), the registry of
named queries and the independent SQL oracle."""
