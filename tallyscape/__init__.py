"""Spark operators for analysing counts by place, category and period.

Vocabulary used throughout: an *entity* is a place, a *category* is what is
counted, a *measure* is the count and a *period* is the year.  A *long* table has
one row per (entity, category, period); a *wide* table has one row per entity and
one column per category.  Every operator takes and returns DataFrames.
"""
