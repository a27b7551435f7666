"""Spark-native cleaning, coding and analysis of messy public tables.

Every operation is a ``DataFrame -> DataFrame`` or ``Column -> Column``
function; nothing here holds a session, a path or a clock of its own.
"""
