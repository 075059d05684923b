"""Job plans: raw -> refine -> conform (M-1), warehouse set-up (M-2), refine -> facts (M-3)."""
