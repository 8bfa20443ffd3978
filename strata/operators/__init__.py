"""Batch operators, one module per hop, plus the ordered-history tools they share."""
