"""DataFrame operators: pages (B), menus (C), board (D), incremental (E), quality (F)."""
