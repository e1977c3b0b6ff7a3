"""Ledgerline: regulatory-capital disclosures as DataFrames, from table cells
and structured filings to reconciled, routed, stored and compared figures."""
