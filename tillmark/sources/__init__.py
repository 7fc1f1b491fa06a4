"""Table readers, file scans and generated calendars."""
