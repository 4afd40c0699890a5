"""Generic DataFrame-to-DataFrame operators; no domain table is named here."""
