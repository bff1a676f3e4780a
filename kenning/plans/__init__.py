"""Composite plans: the four pipelines (mail, chat, teams, interests) and the
registry of queries over the driver's tables (``kenning.plans.standins``)."""
