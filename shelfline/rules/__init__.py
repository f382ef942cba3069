"""Row rules that turn raw records into the dimensions and facts of the star."""
