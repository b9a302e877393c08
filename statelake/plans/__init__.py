"""Views, their catalogue, the read API, the quality report and the export."""
