"""The registered queries: every operator over whole tables, and its SQL counterpart."""
