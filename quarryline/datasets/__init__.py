"""Declared tables of the published open-data sets: raw text in, typed and coded
tables out, plus the analyses made on them."""
