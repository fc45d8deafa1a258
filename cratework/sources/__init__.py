"""Where rows come from: registry, landed archives, ERP extracts."""
