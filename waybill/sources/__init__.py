"""Where rows come from: monthly files, the zone CSV, catalog tables, literals, calendars."""
